"""Product sinks (K-01..K-06).

Products are written by the executors (parquet by default, CSV with a
header on request); nothing is gathered on the driver.  Sorting for the
product order (O-02) happens only here, as a distributed range sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def prepare_product(df: DataFrame, drop: Sequence[str] = (), text_ts: Sequence[str] = (),
                    order_by: Sequence[Column | str] = ()) -> DataFrame:
    """K-03 timestamps as text, K-04 product-specific column drop, O-02 sink order."""
    out = df.drop(*drop) if drop else df
    if text_ts:
        out = out.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in text_ts})
    if order_by:
        out = out.orderBy(*order_by)
    return out


def write_product(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                  partition_by: Sequence[str] = ()) -> None:
    """K-01 / K-05: write a product (CSV gets a header and no row names)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def z_order(lat: Column | str, lon: Column | str, bits: int = 24) -> Column:
    """The Z-order key of a cell: the bits of its two indices interleaved, so cells near in both axes are near in the key."""
    lat, lon = (F.col(c) if isinstance(c, str) else c for c in (lat, lon))

    def bit(c: Column, b: Column) -> Column:
        return F.call_function("shiftright", c.cast("long"), b).bitwiseAND(F.lit(1).cast("long"))

    pair = lambda key, b: key * 4 + bit(lat, b) * 2 + bit(lon, b)
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0)), F.lit(0).cast("long"), pair)


def write_grid(grid: DataFrame, path: str, partition_by: Sequence[str] = ("product", "resolution", "period"),
               row_group_bytes: int = 1 << 20, tasks: int | None = None) -> None:
    """K-06: a gridded layer as one row per cell, partitioned by layer and clustered in both axes.

    Rows are range-partitioned by (layer, Z-order key), so a large layer is many
    tasks' work and small ones share a task, and sorted by it, so a row group
    holds a compact block of cells: its statistics of ``lat_idx`` and ``lon_idx``
    let a box filter skip all row groups but those the box meets.  ``tasks``: number
    of ranges (default: the shuffle partitions).
    """
    by = [*[F.col(c) for c in partition_by], F.col("__z")]
    laid = grid.withColumn("__z", z_order("lat_idx", "lon_idx"))
    laid = laid.repartitionByRange(tasks, *by) if tasks else laid.repartitionByRange(*by)
    (laid.sortWithinPartitions(*by).drop("__z").write.mode("overwrite").option("parquet.block.size", row_group_bytes)
     .option("parquet.page.size", max(1024, row_group_bytes // 8)).partitionBy(*partition_by).parquet(path))
