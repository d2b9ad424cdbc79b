"""Null-faithful aggregates and predicates.

The source scripts rely on R semantics that differ from SQL defaults:
``sum(na.rm=TRUE)`` of nothing is 0, plain ``sum``/``max`` return NA as soon
as one input is NA, ``!(NA %in% S)`` keeps the row, ``grepl`` on NA is FALSE.
Each helper here returns a Column so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sum0(c: str | Column) -> Column:
    """A-01: sum ignoring nulls; an empty or all-null group gives 0."""
    return F.coalesce(F.sum(_c(c)), F.lit(0))


def mean_na(c: str | Column) -> Column:
    """A-02: mean ignoring nulls; all-null gives null (R: NaN, folded to NA)."""
    return F.avg(_c(c))


def strict_sum(c: str | Column) -> Column:
    """A-04: sum that is null as soon as one input is null."""
    c = _c(c)
    return F.when(F.count_if(c.isNull()) > 0, F.lit(None)).otherwise(F.sum(c))


def strict_max(c: str | Column) -> Column:
    """A-05: max that is null as soon as one input is null."""
    c = _c(c)
    return F.when(F.count_if(c.isNull()) > 0, F.lit(None)).otherwise(F.max(c))


def safe_div(a: str | Column, b: str | Column) -> Column:
    """N-12: x/0 gives null instead of an ANSI error."""
    return F.try_divide(_c(a), _c(b))


def matches(c: str | Column, pattern: str) -> Column:
    """P-04 / N-6: regex match where a null input is 'no match' (False)."""
    return F.coalesce(_c(c).rlike(pattern), F.lit(False))


def not_matches(c: str | Column, pattern: str) -> Column:
    """Negated P-04: null input counts as not matching, so the row is kept."""
    return ~matches(c, pattern)


def not_in(c: str | Column, values: Iterable) -> Column:
    """P-03 / N-5: ``!(x %in% values)``; a null x is kept (True)."""
    return F.coalesce(~_c(c).isin(list(values)), F.lit(True))


def not_in_frame(df: DataFrame, col: str, keys: DataFrame, key_col: str | None = None) -> DataFrame:
    """P-03 against a key table: left-anti join; null keys never match so they are kept."""
    key_col = key_col or col
    k = keys.select(F.col(key_col).alias("__k")).where(F.col("__k").isNotNull()).distinct()
    return df.join(k, df[col] == k["__k"], "left_anti")


def nan_to_null(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """S-06 / N-4: fold NaN to null over every float column (or ``cols``)."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    cols = list(cols)
    if not cols:
        return df
    return df.withColumns({c: F.when(F.isnan(F.col(c)), F.lit(None)).otherwise(F.col(c)) for c in cols})


def first_word(c: str | Column) -> Column:
    """F-09: first space-separated word; null stays null, blank gives ''."""
    return F.split_part(_c(c), F.lit(" "), F.lit(1))
