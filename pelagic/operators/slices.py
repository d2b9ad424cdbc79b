"""Cutting hot groups by value: slices of bounded size for ordered scans and selections.

A group with more rows than a task should order is cut at its quantiles, which a
sketch finds in one aggregation.  Each slice is then ordered on its own, and a
scan over the slices (a few rows per group) carries what lies before and after.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagic.operators.axes import count_up_to


def cut_slices(df: DataFrame, by: str, x: str, slice_rows: int) -> DataFrame:
    """``df`` with ``__slice``, 0.. in the order of ``x``: groups above ``slice_rows`` rows are cut at quantiles of ``x``.

    A group gets a slice per ``slice_rows`` rows, at most one per shuffle
    partition, so the groups that are cut are few and their cuts small.  Equal
    values share a slice: make the values distinct first if one may be hot.
    """
    most = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shares = [k / most for k in range(1, most)]
    stats = df.groupBy(by).agg(F.count(F.lit(1)).alias("__n"), F.percentile_approx(x, shares, 20 * most).alias("__q"))
    slices = F.least(F.ceil(F.col("__n") / F.lit(slice_rows)), F.lit(most)).cast("int")
    # every (most / slices)-th quantile; a value that fills several gets one
    picked = F.transform(F.sequence(F.lit(1), slices - 1), lambda k: F.get("__q", F.floor(k * F.lit(most) / slices).cast("int") - 1))
    cuts = stats.where(F.col("__n") > F.lit(slice_rows)).select(F.col(by).alias("__cby"), F.array_distinct(picked).alias("__cuts"))
    cut = df.join(cuts, df[by].eqNullSafe(cuts["__cby"]), "left").drop("__cby")
    at = F.when(F.col("__cuts").isNull(), F.lit(0)).otherwise(count_up_to(F.col("__cuts"), F.col(x), most))
    return cut.withColumn("__slice", at).drop("__cuts")
