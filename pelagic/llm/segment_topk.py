"""Exact top-k inner products by multi-resolution segment statistics.

A vector is cut into segments; ``f(x)`` holds, per segment of length l, its mean
times sqrt(l) and its deviation (root of the summed squares around the mean).
``|f(q) - f(x)|`` never exceeds ``|q - x|``, and ``|f(x)| = |x|``, so with

    q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2

the lower bound of the distance is an upper bound of the score.  For each query
the coarsest level bounds every candidate; the best few give an exact k-th
score; candidates whose bound lies below it are dropped, level by level, and
the survivors are scored exactly in integers.  A bound equal to the k-th score
survives, so ties are settled by the smaller id.

Queries and candidates meet in tiles (a block of queries against a block of
candidates), so no task holds more than one tile; the tiles' best k per query
are merged by a window.  The number of blocks follows the counted rows.

Vectors are quantised to floor(scale * x).  Null vectors, those with null or
non-finite components and null ids take no part; vectors of other lengths are
not compared; empty vectors score 0 with each other.  Rows are told apart by id:
a query's own id is never its neighbour, and a repeated query id is asked once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

SEGMENTS = (2, 8, 16)


def quantised(vec: Column, scale: int) -> Column:
    """floor(scale * x) of each component, as long."""
    return F.transform(vec, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def is_valid(vec: Column) -> Column:
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    return vec.isNotNull() & ~F.coalesce(bad, F.lit(False))


def segment_features(x: np.ndarray, segments: int) -> np.ndarray:
    """Per row: sqrt(l) * mean and deviation of each of ``segments`` pieces (short vectors: fewer)."""
    out = []
    for part in np.array_split(x, max(1, min(segments, x.shape[1])), axis=1):
        if part.shape[1]:
            mean = part.mean(axis=1)
            out.append(mean * math.sqrt(part.shape[1]))
            out.append(np.sqrt(((part - mean[:, None]) ** 2).sum(axis=1)))
    return np.stack(out, axis=1) if out else np.zeros((len(x), 1))


def best_in_tile(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int,
                 step: int = 128) -> list[tuple[int, int, int]]:
    """(query id, candidate id, score) of each query's k best candidates of the tile, ties to the smaller id."""
    order = np.argsort(c_ids, kind="stable")
    c_ids, c = c_ids[order], c[order]
    cf, qf = c.astype(float), q.astype(float)
    levels = [(segment_features(qf, s), segment_features(cf, s)) for s in SEGMENTS]
    slack = 1e-9 * (1 + float(np.abs(qf).max(initial=0)) * float(np.abs(cf).max(initial=0)) * max(1, q.shape[1]))
    out = []
    for lo in range(0, len(q), step):
        coarse = levels[0][0][lo:lo + step] @ levels[0][1].T
        for r in range(coarse.shape[0]):
            i = lo + r
            bound = coarse[r]
            bound[c_ids == q_ids[i]] = -np.inf
            m = int((bound > -np.inf).sum())
            if not m:
                continue
            near = np.argpartition(-bound, min(8 * k, len(bound) - 1))[:8 * k]
            near = near[bound[near] > -np.inf]
            exact = c[near] @ q[i]
            least = np.sort(exact)[-k] if len(exact) >= k else -np.inf
            alive = np.flatnonzero((bound >= least - slack) & (bound > -np.inf))
            for fq, fc in levels[1:]:
                alive = alive[fc[alive] @ fq[i] >= least - slack]
            score = c[alive] @ q[i]
            top = np.lexsort((c_ids[alive], -score))[:k]
            out += [(int(q_ids[i]), int(c_ids[alive[t]]), int(score[t])) for t in top]
    return out


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, *, id_col: str = "vec_id", vec: str = "embedding",
          scale: int = 256, candidate_tile: int = 8192, query_tile: int = 16384) -> DataFrame:
    """Each query's ``k`` best rows of ``vectors``: query_id, rank (from 1), ``id_col``, score."""
    def prepared(df: DataFrame) -> DataFrame:
        df = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec).alias("raw"))
        df = df.filter(F.col("id").isNotNull() & is_valid(F.col("raw")))
        return df.select("id", F.size("raw").alias("d"), quantised(F.col("raw"), scale).alias("v"))

    cand = prepared(vectors)
    ask = prepared(queries).groupBy("id", "d").agg(F.min("v").alias("v"))
    # Counts from the id column alone: they only size the tiles.
    n = vectors.filter(F.col(id_col).isNotNull()).count()
    m = queries.filter(F.col(id_col).isNotNull()).count()
    c_blocks, q_blocks = max(1, math.ceil(n / candidate_tile)), max(1, math.ceil(m / query_tile))

    def block(salt: int, blocks: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(blocks)).cast("int")

    cand = cand.withColumns({"cb": block(1, c_blocks), "qb": F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)))})
    ask = ask.withColumns({"qb": block(2, q_blocks), "cb": F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1)))})

    def tile(c: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(c) and len(q):
            d = int(c["d"].iloc[0])
            as_matrix = lambda s: np.array([*s], dtype=np.int64).reshape(len(s), d)
            rows = best_in_tile(q["id"].to_numpy(), as_matrix(q["v"]), c["id"].to_numpy(), as_matrix(c["v"]), k)
        return pd.DataFrame(rows, columns=["query_id", "id", "score"])

    keys = ["d", "cb", "qb"]
    met = cand.groupBy(*keys).cogroup(ask.groupBy(*keys)).applyInPandas(tile, "query_id long, id long, score long")
    w = W.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = met.withColumn("rank", F.row_number().over(w).cast("int")).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")
