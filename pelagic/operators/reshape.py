"""Long <-> wide reshaping (V-01..V-04, P-15, A-25).

The long form (key, taxon, value) is canonical.  A wide sample x taxon matrix
is produced only at the sink (``to_wide``), with an explicit, sorted column
list, so the planner never has to discover pivot values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pelagic.functions.nulls import sum0
from pelagic.operators.slices import cut_slices


def pivot_values(df: DataFrame, col: str) -> list:
    """Sorted distinct non-null values of ``col``: the column list of a wide table, which its schema needs on the driver."""
    return [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col).collect()]


def to_wide(df: DataFrame, ids: Sequence[str], col: str, value: str, values: Sequence | None = None,
            fill=None, unique_cells: bool = False) -> DataFrame:
    """V-01 / V-02: long -> wide, one column per value of ``col`` (sorted, O-01).

    ``fill`` replaces *absent* cells only; a cell present with an explicit null
    stays null (N-15).  Without ``fill`` absent cells are null (V-02).

    Cells are reduced to one value per (ids, col) (skipped when the caller
    guarantees ``unique_cells``; map-side partial aggregation combines a hot
    key before the shuffle), gathered per ``ids`` into a map bounded by the
    column list, and read out with one lookup per column.  Every key gets a
    row even when none of its cells is listed.  One form serves any number of
    columns and any value type.
    """
    ids = list(ids)
    values = list(pivot_values(df, col) if values is None else values)
    cells = df if unique_cells else df.groupBy(*ids, col).agg(F.first(value, ignorenulls=True).alias(value))
    m = cells.groupBy(*ids).agg(
        F.map_from_entries(F.collect_list(F.when(F.col(col).isin(values), F.struct(col, value)))).alias("__m"))
    out = [F.col(x) for x in ids]
    for x in values:
        cell = F.element_at(F.col("__m"), F.lit(x))
        if fill is not None:
            cell = F.when(F.map_contains_key(F.col("__m"), F.lit(x)), cell).otherwise(F.lit(fill))
        out.append(cell.alias(str(x)))
    return m.select(*out)


def sparse_matrix(obs: DataFrame, key: str, taxon: str, value: str) -> DataFrame:
    """V-01 in canonical long form: the sum per (key, taxon) that has records.

    Absent cells stay absent (they are zero by definition); zeros are written
    only by a wide sink (``to_wide`` with ``fill``), never as rows.
    """
    return obs.groupBy(key, taxon).agg(sum0(value).alias(value))


def melt(df: DataFrame, ids: Sequence[str], value_cols: Sequence[str], var: str = "variable",
         value: str = "value", dropna: bool = True) -> DataFrame:
    """V-03 / S-21: wide -> long (``unpivot``), optionally dropping null cells."""
    out = df.unpivot(list(ids), list(value_cols), var, value)
    return out.where(F.col(value).isNotNull()) if dropna else out


def drop_empty_taxa(df: DataFrame, taxon: str, value: str) -> DataFrame:
    """P-15: remove taxa whose column total is 0 (long form: aggregate + semi join)."""
    keep = df.groupBy(taxon).agg(F.sum(value).alias("__tot")).where(F.col("__tot") != 0).select(taxon)
    return df.join(keep, taxon, "left_semi")


QUARTILES = (("q1", 0.25), ("median", 0.5), ("q3", 0.75))


def column_summary(df: DataFrame, taxon: str, value: str, quantiles: bool = True, slice_rows: int = 100_000) -> DataFrame:
    """A-25: per-taxon total, min, max, mean, count and exact interpolated quartiles of a long matrix."""
    aggs = [F.sum(value).alias("total"), F.min(value).alias("min"), F.max(value).alias("max"),
            F.avg(value).alias("mean"), F.count(F.lit(1)).alias("n")]
    sums = df.groupBy(taxon).agg(*aggs)
    if not quantiles:
        return sums
    q = exact_quantiles(df, taxon, value, QUARTILES, slice_rows).withColumnRenamed(taxon, "__taxon")
    same = F.col(taxon).eqNullSafe(F.col("__taxon"))
    return sums.join(q, same, "left").drop("__taxon")


def exact_quantiles(df: DataFrame, by: str, value: str, shares: Sequence[tuple[str, float]], slice_rows: int = 100_000) -> DataFrame:
    """Exact interpolated quantiles per group, one column per (name, share), by distributed selection.

    Values are counted once per distinct value.  A group with many of them is cut
    into slices by value; the counts of the slices tell which ones hold the ranks
    asked for, and only those are ordered.  No task holds the values of a group,
    and no aggregate keeps a list of values.
    """
    d = df.where(F.col(value).isNotNull()).groupBy(F.col(by).alias("__by"), F.col(value).cast("double").alias("__x")).agg(F.count(F.lit(1)).alias("__c"))
    s = cut_slices(d, "__by", "__x", slice_rows)
    counts = s.groupBy("__by", "__slice").agg(F.sum("__c").alias("__m"))
    w = Window.partitionBy("__by")
    upto = F.sum("__m").over(w.orderBy("__slice").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counts = counts.select("__by", "__slice", (upto - F.col("__m")).alias("__before"), upto.alias("__upto"), F.sum("__m").over(w).alias("__n"))

    def rank(share: float, end) -> Column:
        return end((F.col("__n") - 1) * F.lit(share)).cast("long")

    ranks = F.array(*[rank(q, end) for _, q in shares for end in (F.floor, F.ceil)])
    asked = counts.where(F.exists(ranks, lambda r: (r >= F.col("__before")) & (r < F.col("__upto")))).select(
        F.col("__by").alias("__aby"), F.col("__slice").alias("__as"), "__before", "__n")
    met = s.join(asked, s["__by"].eqNullSafe(asked["__aby"]) & (s["__slice"] == asked["__as"]))
    inside = F.sum("__c").over(Window.partitionBy("__by", "__slice").orderBy("__x").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last = met.select("__by", "__x", "__n", (F.col("__before") + inside).alias("__hi"), "__c")

    def at(r: Column) -> Column:
        return F.max(F.when((r >= F.col("__hi") - F.col("__c")) & (r < F.col("__hi")), F.col("__x")))

    ends = last.groupBy("__by").agg(F.first("__n").alias("__n"), *[at(rank(q, end)).alias(f"__{name}_{k}") for name, q in shares
                                                                 for k, end in enumerate((F.floor, F.ceil))])

    def between(name: str, q: float) -> Column:
        p = (F.col("__n") - 1) * F.lit(q)
        lo, hi = F.col(f"__{name}_0"), F.col(f"__{name}_1")
        return F.when(lo == hi, lo).otherwise((F.ceil(p) - p) * lo + (p - F.floor(p)) * hi)

    return ends.select(F.col("__by").alias(by), *[between(name, q).alias(name) for name, q in shares])
