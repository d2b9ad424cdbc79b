"""As-of joins (J-05, J-06, F-23).

Spark has no native as-of join.  Both operators are a union of the two
sides' instants followed by ordered window scans over slices of a group's time,
so that a hot group is split across many tasks; what lies beyond a slice's edges
is carried over by a scan over the slices.  No pair of rows is ever materialised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pelagic.functions.timeops import epoch_micros
from pelagic.operators.slices import cut_slices

_US_PER_HOUR = 3_600_000_000


def nearest_asof(left: DataFrame, right: DataFrame, by: str, left_time: str, right_time: str,
                 left_id: str, right_id: str, tolerance_h: Column | float = 3.0,
                 max_tolerance_h: float | None = None, slice_rows: int = 100_000) -> DataFrame:
    """J-05: for each left row, the right row(s) of the same ``by`` group nearest in time.

    Ties in distance go to the earlier right time; a match further than the
    row's tolerance is dropped (left row kept with nulls).  The tolerance is a
    number of hours, or a Column with ``max_tolerance_h`` as its upper bound: a
    row above the bound fails the job, it is never clipped; a null tolerance
    matches nothing.  All right rows at the matched time are returned, as the
    source inner-joins on the cast time.  Output: left columns + ``match_time``, ``<right_id>``, ``diff_h``.

    The work is done on distinct (group, time) instants, so rows of one instant
    are one.  A group with more than ``slice_rows`` instants is cut at its time
    quantiles; each slice is scanned on its own, and the last cast before and the
    first cast after it are carried over its edges by a scan over the slices
    (a few rows per group).  No slice depends on the tolerance, no row is copied.
    """
    if isinstance(tolerance_h, Column):
        if max_tolerance_h is None:
            raise ValueError("a tolerance column needs max_tolerance_h, its upper bound")
        too_wide = F.raise_error(F.lit(f"tolerance above max_tolerance_h = {max_tolerance_h} h")).cast("double")
        tol = F.when(tolerance_h > F.lit(float(max_tolerance_h)), too_wide).otherwise(tolerance_h.cast("double"))
    else:
        tol = F.lit(float(tolerance_h))

    lt = left.withColumn("__t", epoch_micros(left_time)).withColumn("__tol", tol)
    lk = lt.select(F.col(by).alias("__by"), "__t", F.lit(0).alias("__cast"))
    rk = right.select(F.col(by).alias("__by"), epoch_micros(right_time).alias("__t"), F.lit(1).alias("__cast"))
    # one column holds the instant and whether a cast lies on it, so every use below reads the same shuffle
    instants = (lk.unionByName(rk).where(F.col("__by").isNotNull() & F.col("__t").isNotNull())
                .groupBy("__by", "__t").agg(F.max(F.col("__t") * 2 + F.col("__cast")).alias("__tc")).select("__by", "__tc"))
    m = _neighbours(instants, slice_rows)
    dp = F.col("__t") - F.col("__prev")
    dn = F.col("__next") - F.col("__t")
    best = (F.when(F.col("__prev").isNull(), F.col("__next"))
            .when(F.col("__next").isNull(), F.col("__prev"))
            .when(dp <= dn, F.col("__prev")).otherwise(F.col("__next")))
    m = m.select(F.col("__by").alias("__mby"), F.col("__t").alias("__mt"), best.alias("__best"),
                 (F.abs(best - F.col("__t")) / F.lit(float(_US_PER_HOUR))).alias("__diff")).where(F.col("__best").isNotNull())

    lm = lt.join(m, (lt[by] == m["__mby"]) & (lt["__t"] == m["__mt"]), "left").drop("__mby", "__mt")
    ok = F.col("__diff") <= F.col("__tol")
    lm = lm.withColumn("__best", F.when(ok, F.col("__best"))).withColumn("__diff", F.when(ok, F.col("__diff")))
    r2 = right.select(F.col(by).alias("__rby"), epoch_micros(right_time).alias("__rbest"),
                      F.col(right_time).alias("match_time"), F.col(right_id))
    out = lm.join(r2, (lm[by] == r2["__rby"]) & (lm["__best"] == r2["__rbest"]), "left")
    return out.drop("__rby", "__rbest", "__t", "__tol", "__best").withColumnRenamed("__diff", "diff_h")


def _neighbours(instants: DataFrame, slice_rows: int) -> DataFrame:
    """Per instant (``__tc``: twice its time, plus one on a cast) its time ``__t`` and the nearest cast times at or
    before (``__prev``) and at or after it (``__next``)."""
    s = cut_slices(instants, "__by", "__tc", slice_rows)
    when = F.when(F.col("__tc").bitwiseAND(1) == 1, F.shiftright("__tc", 1))
    w = Window.partitionBy("__by", "__slice").orderBy("__tc")
    inside = s.select("__by", "__slice", F.shiftright("__tc", 1).alias("__t"),
                      F.last(when, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("__prev"),
                      F.first(when, ignorenulls=True).over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing)).alias("__next"))
    edges = s.groupBy("__by", "__slice").agg(F.min(when).alias("__lo"), F.max(when).alias("__hi"))
    e = Window.partitionBy("__by").orderBy("__slice")
    edges = edges.select(F.col("__by").alias("__eby"), F.col("__slice").alias("__es"),
                         F.max("__hi").over(e.rowsBetween(Window.unboundedPreceding, -1)).alias("__before"),
                         F.min("__lo").over(e.rowsBetween(1, Window.unboundedFollowing)).alias("__after"))
    j = inside.join(edges, (inside["__by"] == edges["__eby"]) & (inside["__slice"] == edges["__es"]))
    return j.select("__by", "__t", F.coalesce("__prev", "__before").alias("__prev"), F.coalesce("__next", "__after").alias("__next"))


def forward_asof(points: DataFrame, axis: DataFrame, point_key: str, axis_value: str,
                 bucket: float = 366.0) -> DataFrame:
    """J-06: for each point key value, the first axis value strictly greater.

    Works on the distinct key values (small: one per lattice step), so a hot
    key costs nothing extra; within a bucket of ``bucket`` units a window scan
    finds the next axis value, and a key whose bucket has none falls back to
    the minimum of the next non-empty bucket.  Output: points + ``next_value``.
    """
    keys = points.select(F.col(point_key).alias("__k")).where(F.col("__k").isNotNull()).distinct()
    ax = axis.select(F.col(axis_value).alias("__k")).where(F.col("__k").isNotNull()).distinct()
    bk = F.floor(F.col("__k") / F.lit(bucket))
    u = (keys.select("__k", F.lit(1).alias("__side"), bk.alias("__b"))
         .unionByName(ax.select("__k", F.lit(0).alias("__side"), bk.alias("__b"))))
    # strictly greater: at equal values the axis row sorts before the key row,
    # so it is not among the rows following the key
    w = Window.partitionBy("__b").orderBy(F.col("__k"), F.col("__side"))
    nxt = F.first(F.when(F.col("__side") == 0, F.col("__k")), ignorenulls=True).over(
        w.rowsBetween(1, Window.unboundedFollowing))
    within = u.select("__k", "__b", "__side", nxt.alias("__in")).where(F.col("__side") == 1)
    # per-bucket minimum axis value, then the minimum over all later buckets:
    # a running minimum over the bucket-level table (one row per bucket).
    mins = ax.groupBy(bk.alias("__b")).agg(F.min("__k").alias("__m"))
    kb = within.select("__b").distinct().withColumn("__m", F.lit(None).cast(mins.schema["__m"].dataType))
    wb = Window.orderBy(F.col("__b").desc(), F.col("__m").isNotNull()).rowsBetween(Window.unboundedPreceding, -1)
    later = (mins.unionByName(kb).withColumn("__later", F.min("__m").over(wb))
             .where(F.col("__m").isNull()).select("__b", "__later"))
    res = within.join(later, "__b", "left").select(
        F.col("__k").alias(point_key), F.coalesce("__in", "__later").alias("next_value"))
    return points.join(res, point_key, "left")
