"""Quality control, key spines and audits (P-05..P-08, P-11, A-06, A-17, A-18, U-01, W-05, W-06)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Quality flags of the source data.  Values carrying a "bad" flag are
# masked; "good" flags are the ones a keep-filter retains.
BAD_FLAGS = (3, 4, 9)
GOOD_FLAGS = (0, 1, 2, 5, 8)


def mask_flags(df: DataFrame, value_flag: Mapping[str, str], bad: Iterable[int] = BAD_FLAGS) -> DataFrame:
    """P-05: set each value to null where its flag is in ``bad`` (null flag keeps the value)."""
    bad = list(bad)
    return df.withColumns({
        v: F.when(F.col(f).isNull() | ~F.col(f).isin(bad), F.col(v)) for v, f in value_flag.items()
    })


def keep_flags(df: DataFrame, flag: str, good: Iterable[int] = GOOD_FLAGS) -> DataFrame:
    """P-06: keep rows whose flag is in ``good`` (null flag dropped)."""
    return df.where(F.col(flag).isin(list(good)))


def valid_range(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """P-11: values <= lo or >= hi become null."""
    c = F.col(col)
    return df.withColumn(col, F.when((c > lo) & (c < hi), c))


def replicate_mean(df: DataFrame, keys: Sequence[str], values: Sequence[str],
                   sum_cols: Sequence[str] = ()) -> DataFrame:
    """A-17: mean per key ignoring nulls (all-null -> null); ``sum_cols`` are summed instead (D-03 option)."""
    aggs = [F.avg(v).alias(v) for v in values if v not in sum_cols]
    aggs += [F.coalesce(F.sum(v), F.lit(0.0)).alias(v) for v in sum_cols]
    return df.groupBy(*keys).agg(*aggs)


def mean_of_means(df: DataFrame, outer: str, inner: str, values: Sequence[str]) -> DataFrame:
    """A-18: mean per ``outer`` of the per-(outer, inner) means."""
    first = df.groupBy(outer, inner).agg(*[F.avg(v).alias(v) for v in values])
    return first.groupBy(outer).agg(*[F.avg(v).alias(v) for v in values])


def key_spine(dfs: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """U-01: distinct union of the key columns of several sources."""
    out = None
    for d in dfs:
        k = d.select(*keys)
        out = k if out is None else out.unionByName(k)
    return out.distinct()


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A-06: keys occurring more than once, with their count (empty = audit passed)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """W-05 / W-06: one row per key, the one lowest in ``order`` (deterministic ``slice(1)``).

    A hash aggregate with ``min_by`` keeps O(1) state per key and combines
    map-side, so a hot key does not concentrate rows in one task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in rest])
    ordering = F.struct(*[F.col(c) for c in order])
    return (df.groupBy(*keys).agg(F.min_by(row, ordering).alias("__r"))
            .select(*keys, *[F.col(f"__r.{c}").alias(c) for c in rest]))


def exclude_ids(df: DataFrame, col: str, ids: Iterable) -> DataFrame:
    """P-08: drop known-bad ids (literal list; null ids kept).  Written as
    ``isNull OR NOT IN`` so the predicate reaches the parquet reader."""
    return df.where(F.col(col).isNull() | ~F.col(col).isin(list(ids)))


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """P-07: drop rows with a null in ``subset`` (or in any column), as pushable IsNotNull filters."""
    cols = list(subset) if subset else df.columns
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.where(cond) if cond is not None else df
