"""Projection, text-part and key-join helpers (P-01, P-12, F-08, J-01 / N-8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagic.functions.nulls import _c


def select_range(df: DataFrame, first: str, last: str, extra: Sequence[str] = ()) -> DataFrame:
    """P-01: columns from ``first`` to ``last`` in schema order (``a:b``), plus ``extra`` (overlap kept once)."""
    cols = df.columns
    i, j = cols.index(first), cols.index(last)
    picked = cols[min(i, j):max(i, j) + 1]
    return df.select(*picked, *[c for c in extra if c not in picked])


def select_except(df: DataFrame, drop: Sequence[str]) -> DataFrame:
    """P-01: every column but ``drop`` (``select(-c(...))``)."""
    return df.select(*[c for c in df.columns if c not in set(drop)])


def select_positions(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    """P-01: columns by 1-based position."""
    return df.select(*[df.columns[p - 1] for p in positions])


def add_constants(df: DataFrame, values: dict) -> DataFrame:
    """P-12: constant (or typed empty) columns; ``None`` values become null strings unless typed Columns."""
    return df.withColumns({k: (v if isinstance(v, Column) else F.lit(v)) for k, v in values.items()})


def path_part(c: str | Column, n: int, sep: str = "/") -> Column:
    """F-08: the n-th (1-based) part of a delimited path."""
    return F.split_part(_c(c), F.lit(sep), F.lit(n))


def strip_prefix(c: str | Column, n: int) -> Column:
    """F-08: text without its first ``n`` characters (e.g. a 3-letter project prefix on a trip code)."""
    return F.substring(_c(c), n + 1, 1 << 30)


def first_chars(c: str | Column, n: int) -> Column:
    """F-08 / N-18: the first ``n`` characters (``substr(x, 0, n)`` in the source)."""
    return F.substring(_c(c), 1, n)


def key_join(left: DataFrame, right: DataFrame, keys: str | Sequence[str], how: str = "left",
             null_safe: bool = False) -> DataFrame:
    """J-01 on named keys, like ``left.join(right, keys, how)``.

    ``null_safe=True`` matches a null key to a null key (``<=>``), as the
    source's joins do (N-8); Spark plans ``<=>`` as an ordinary equi-join key,
    so the join still shuffles or broadcasts on the keys.  All null keys land
    in one partition, so use it only where null keys are few.  The output
    has one copy of each key column first, then the other left and right columns.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if not null_safe:
        return left.join(right, keys, how)
    r = right.select(*[F.col(k).alias(f"__rk_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"__rk_{k}"])
        cond = c if cond is None else cond & c
    j = left.join(r, cond, how)
    if how in ("semi", "left_semi", "leftsemi", "anti", "left_anti", "leftanti"):
        return j
    takes_right = how in ("right", "right_outer", "rightouter", "full", "outer", "full_outer", "fullouter")
    key_cols = [F.coalesce(left[k], F.col(f"__rk_{k}")).alias(k) if takes_right else left[k] for k in keys]
    return j.select(*key_cols, *[left[c] for c in left.columns if c not in keys],
                    *[F.col(c) for c in right.columns if c not in keys])
