"""Vertical-profile indices (W-01..W-04, A-14..A-16).

Per cast the source loops over trips and ranks rows; here each statistic is
an ``min_by`` / ``max_by`` aggregate keyed by cast (O(1) state per cast,
combined map-side), and the only join attaches the per-cast reference row
back to the cast's rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _nulls_last_key(x: Column, *ties: Column) -> Column:
    """Ordering struct: nulls last, then ascending x, then the tie breakers."""
    return F.struct(x.isNull(), x, *ties)


def reference_row(df: DataFrame, cast: str, depth: str, ref_depth: str | Column, cols: Sequence[str],
                  order: str | None = None) -> DataFrame:
    """W-01: per cast the row whose depth is nearest ``ref_depth`` (ties to the shallower row).

    Columns come back prefixed ``__ref_``.
    """
    rd = F.col(ref_depth) if isinstance(ref_depth, str) else ref_depth
    diff = F.abs(F.col(depth) - rd)
    ties = [F.col(depth)] + ([F.col(order)] if order else [])
    val = F.struct(*[F.col(c) for c in [depth, *cols]])
    r = df.groupBy(cast).agg(F.min_by(val, _nulls_last_key(diff, *ties)).alias("__ref"))
    return r.select(cast, *[F.col(f"__ref.{c}").alias(f"__ref_{c}") for c in [depth, *cols]])


def mixed_layer(df: DataFrame, cast: str = "cast", depth: str = "depth", temp: str = "temp",
                salinity: str = "salinity", chl: str | None = "chl", ref_depth: str | Column = "ref_depth",
                dt: float = 0.4, ds: float = 0.03, order: str | None = None) -> DataFrame:
    """W-02..W-04: mixed-layer depth by temperature and salinity, and the chlorophyll maximum depth.

    Reference row = depth nearest ``ref_depth``; below it (strictly deeper),
    MLD_temp = depth whose temperature is nearest T_ref - ``dt`` and MLD_sal
    the same with S_ref - ``ds`` (nulls ranked last, ties to the shallower
    row).  DCM = depth of the maximum positive chlorophyll below the
    reference, null when any chlorophyll there is null (shallowest on ties).
    A cast with nothing below the reference gets nulls (D-22).
    """
    rd = F.col(ref_depth) if isinstance(ref_depth, str) else ref_depth
    base = df.withColumn("__rd", rd)
    ref = reference_row(base, cast, depth, "__rd", [temp, salinity], order)
    rows = base.join(ref, cast, "left").withColumn("__below", F.col(depth) > F.col(f"__ref_{depth}"))
    below = F.col("__below")
    ties = [F.col(depth)] + ([F.col(order)] if order else [])
    t_diff = F.abs(F.col(temp) - (F.col(f"__ref_{temp}") - F.lit(dt)))
    s_diff = F.abs(F.col(salinity) - (F.col(f"__ref_{salinity}") - F.lit(ds)))
    # rows not below the reference have a null order, which min_by / max_by pass over
    aggs = [F.min_by(F.col(depth), F.when(below, _nulls_last_key(t_diff, *ties))).alias("MLD_temp"),
            F.min_by(F.col(depth), F.when(below, _nulls_last_key(s_diff, *ties))).alias("MLD_sal")]
    if not chl:
        return rows.groupBy(cast).agg(*aggs)
    c = F.col(chl)
    aggs += [F.count_if(below & c.isNull()).alias("__chl_nulls"), F.max(F.when(below, c)).alias("__chl_max"),
             F.max_by(F.col(depth), F.when(below, F.struct(c, -F.col(depth)))).alias("__dcm")]
    dcm = F.when((F.col("__chl_nulls") == 0) & (F.col("__chl_max") > 0), F.col("__dcm"))
    return rows.groupBy(cast).agg(*aggs).select(cast, "MLD_temp", "MLD_sal", dcm.alias("DCM"))


def surface_mean(df: DataFrame, key: str, depth: str, values: Sequence[str], max_depth: float,
                 inclusive: bool = False) -> DataFrame:
    """A-14 / A-15: mean of each value over rows shallower than ``max_depth`` (``<=`` when inclusive)."""
    cond = F.col(depth) <= max_depth if inclusive else F.col(depth) < max_depth
    return df.where(cond).groupBy(key).agg(*[F.avg(v).alias(v) for v in values])


def rounded_depth_mean(df: DataFrame, keys: Sequence[str], depth: str, values: Sequence[str]) -> DataFrame:
    """A-16: depth rounded half-to-even to whole metres (N-11), then mean per (keys, depth)."""
    return (df.withColumn(depth, F.bround(F.col(depth), 0))
            .groupBy(*keys, depth).agg(*[F.avg(v).alias(v) for v in values]))
