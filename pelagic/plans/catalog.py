"""Registry of named queries over the driver tables and their DuckDB oracles.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLES[name] -> SQL``.
Modules under ``pelagic.plans`` register themselves on import.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
BENCH: list[str] = []


def register(name: str, sql: str | None = None, bench: bool = False):
    """Decorator: register a query builder under ``name`` with its oracle SQL."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = dyadic_sql(sql)
        if bench:
            BENCH.append(name)
        return fn

    return deco


# Results are compared after rounding to a binary grid of 2^-20 (about 1e-6):
# scaling by a power of two is exact, and the exact values of means and
# ratios of small counts (denominators 3, 8, 64, ...) never fall half-way
# between grid points, so two engines whose sums differ in the last bits
# still round to the same double.  Decimal rounding would split such ties.
GRID = 1048576.0


def r6(c: Column | str) -> Column:
    """Round to the 2^-20 grid (the Spark side of ``dyadic_sql``)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double") * F.lit(GRID), 0) / F.lit(GRID) + F.lit(0.0)


def rounded(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Round every floating column (``r6``) so value hashes do not depend on summation order.

    ``keep`` names columns computed exactly (e.g. a quotient of integer sums),
    left unrounded: both engines produce the same correctly rounded double.
    """
    cols = {f.name: r6(F.col(f.name))
            for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType)) and f.name not in keep}
    return df.withColumns(cols) if cols else df


def dyadic_sql(sql: str) -> str:
    """Rewrite every ``round(expr, 6)`` of an oracle into the same 2^-20 grid rounding as ``r6``."""
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, comma = 0, j + 6, None
        while k < len(sql):
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                if depth == 0:
                    break
                depth -= 1
            elif ch == "," and depth == 0:
                comma = k
            k += 1
        if comma is None or sql[comma + 1:k].strip() != "6":
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        inner = dyadic_sql(sql[j + 6:comma])
        out.append(sql[i:j])
        out.append(f"CAST(round(CAST({inner} AS DOUBLE) * {GRID}) / {GRID} AS DOUBLE)")
        i = k + 1


def load_all() -> None:
    """Import every plan module so its queries are registered."""
    from pelagic.plans import (  # noqa: F401
        q_indices, q_matrices, q_qc, q_profile, q_asof, q_time, q_mooring, q_grid,
        q_regions, q_community, q_products, q_jobs, q_surface, q_basics, q_points,
    )
