"""SimHash near-dedup by the generalised pigeonhole principle.

A fingerprint has bit b set if over half of the text's word shingles (repeats
included) have it set in their XXH64 (seed 42, UTF-8).  Fewer words than a
shingle: the whole sequence is one shingle; no word (or null text): zero.

Fingerprints at most ``max_distance`` bits apart are linked.  The 64 bits are
split into parts, correlated bits together, with a threshold t_i per part so
that the t_i + 1 add up to max_distance + 1: two linked fingerprints must agree
to t_i bits on some part i.  Parts and thresholds come from dynamic programming
over the candidate counts estimated on a bounded sample of fingerprints; the
choice changes the cost, never the answer.

Probing is symmetric: a fingerprint files itself under each way of blanking t_i
bits of part i, so two that agree to t_i bits share a bucket.  Buckets above
``hot_bucket`` are refined: their members differ by at most max_distance outside the
part, so max_distance + 1 pieces of the remaining bits form finer buckets, and
again once more; what is still hot is cut into slices that meet two by two.
Inside a bucket every pair is verified and a spanning forest of the links goes
out, never all pairs.

Equal fingerprints are one node throughout.  Components come from alternating
large and small stars over the links, checkpointed each round.  A document's
component is the smallest id in it; null ids count only if there is no other.
Repeated rows get equal answers; extra columns are not touched.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagic.llm.common import WORD, checkpointed, fresh, own_columns, small_broadcast, text_batches

WORDS = re.compile(WORD)
UPPER_RUN = re.compile("[A-Z]+")
SEED = 42  # fixed value of the contract
BITS = 64
PIECE = 1 << 16  # shingles hashed together


def fingerprint(text: str | None, shingle: int) -> int:
    """The fingerprint of one whole text, as an unsigned number."""
    if not text:
        return 0
    words = WORDS.findall(text.lower() if text.isascii() else UPPER_RUN.sub(lambda m: m.group().lower(), text))
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(BITS, dtype=np.int64)
    for lo in range(0, n, PIECE):
        part = words[lo:lo + PIECE + shingle - 1]
        grams = map(" ".join, zip(*[part[k:] for k in range(shingle)])) if len(words) >= shingle else [" ".join(words)]
        h = np.fromiter((digest(g, SEED) for g in grams), dtype=np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprint_column(docs: DataFrame, text: Column, shingle: int) -> Column:
    """Fingerprints of whole texts as signed longs."""
    text_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))

    return run.asNondeterministic()(text)


# ---- partition plan -------------------------------------------------------

def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask


def mask_of(bits) -> int:
    return sum(1 << int(b) for b in bits)


def group_bits(sample: np.ndarray, parts: int) -> list[list[int]]:
    """Split the bits into ``parts`` groups of like size, each grown from the bits most correlated with it."""
    x = ((sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(float)
    x -= x.mean(axis=0, keepdims=True) if len(x) else 0
    norm = np.sqrt((x ** 2).sum(axis=0))
    corr = np.abs(x.T @ x) / np.maximum(np.outer(norm, norm), 1e-12)
    free, out = list(range(BITS)), []
    for k in range(parts):
        size = len(free) // (parts - k)
        group = [free.pop(0)]
        while len(group) < size:
            best = max(free, key=lambda b: (corr[b, group].mean(), -b))
            free.remove(best)
            group.append(best)
        out.append(sorted(group))
    return out


def allocate(sample: np.ndarray, groups: list[list[int]], n: int, budget: int, row_cost: float = 200.0) -> tuple[float, list[int]]:
    """Cheapest thresholds t_i >= -1 with sum(t_i + 1) == budget, by dynamic programming."""
    apart = sample[:, None] ^ sample[None, :]
    pairs = max(1, len(sample) * (len(sample) - 1))
    cost = []
    for g in groups:
        near = np.bitwise_count(apart & np.uint64(mask_of(g)))
        own = []
        for t in range(-1, min(budget, len(g) + 1)):
            if t < 0:
                own.append(0.0)
                continue
            seen = (int((near <= t).sum()) - len(sample)) / pairs
            even = sum(math.comb(len(g), i) for i in range(t + 1)) / 2.0 ** len(g)
            own.append(n * n / 2 * max(seen, even) + n * math.comb(len(g), t) * row_cost)
        cost.append(own)
    best = {0: (0.0, [])}
    for own in cost:
        best = {b: min(((c + own[use], [*t, use - 1]) for had, (c, t) in best.items()
                        if 0 <= (use := b - had) < len(own)), default=(math.inf, []))
                for b in range(budget + 1)}
    return best[budget]


def probe_masks(sample: np.ndarray, n: int, max_distance: int) -> list[int]:
    """The bit masks to file each fingerprint under, for the cheapest number of parts."""
    budget = max_distance + 1
    best = (math.inf, [], [])
    for parts in range(1, budget + 1):
        groups = group_bits(sample, parts)
        c, t = allocate(sample, groups, n, budget)
        if c < best[0]:
            best = (c, groups, t)
    return [mask_of(set(g) - set(blank)) for g, t in zip(best[1], best[2]) if t >= 0 for blank in combinations(g, t)]


def refined(mask: int, pieces: int) -> list[int]:
    """The bits outside ``mask`` dealt to ``pieces`` masks."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    return [mask_of(free[k::pieces]) for k in range(pieces)]


# ---- links ----------------------------------------------------------------

def filed(fps: DataFrame, masks: list[int]) -> DataFrame:
    """(key, mask, fp): one row per fingerprint and mask."""
    m = F.array(*[F.lit(signed(x)).cast("long") for x in masks])
    rows = F.transform(m, lambda x, i: F.struct(F.xxhash64(i, F.col("fp").bitwiseAND(x)).alias("key"), x.alias("mask")))
    return fps.select("fp", F.explode(rows).alias("r")).select("r.key", "r.mask", "fp")


def spanning(fp: np.ndarray, max_distance: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of one bucket (unsigned fingerprints)."""
    out, left = [], fp
    limit = np.uint8(max_distance)
    while len(left) > 1:
        seed, left = left[:1], left[1:]
        front = list(seed)
        while front and len(left):
            f = front.pop()
            near = np.bitwise_count(left ^ f) <= limit
            if near.any():
                got = left[near]
                left = left[~near]
                front.extend(got)
                out += [(int(g), int(f)) for g in got]
    return out


def bucket_links(max_distance: int):
    """mapInPandas body over rows sorted by key: links of each bucket, bucket by bucket."""
    limit = np.uint8(max_distance)

    def links_of(key: np.ndarray, fp: np.ndarray) -> list[tuple[int, int]]:
        out = []
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.diff(np.r_[start, len(key)])
        pair = size == 2  # most buckets: all at once
        a, b = fp[start[pair]], fp[start[pair] + 1]
        near = np.bitwise_count(a ^ b) <= limit
        out += zip(b[near].tolist(), a[near].tolist())
        for s, n in zip(start[size > 2], size[size > 2]):
            group = fp[s:s + n]
            if n <= 32:  # nothing to link in most: one look at all pairs
                d = np.bitwise_count(group[:, None] ^ group[None, :]) <= limit
                if int(d.sum()) == n:
                    continue
            out += spanning(group, max_distance)
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: list[tuple[np.ndarray, np.ndarray]] = []
        for pdf in batches:
            key, fp = pdf["key"].to_numpy(), pdf["fp"].to_numpy().view(np.uint64)
            if not len(key):
                continue
            if rest and rest[-1][0][-1] == key[-1]:
                rest.append((key, fp))
                continue
            cut = int(np.searchsorted(key, key[-1], "left"))
            whole, rest = [*rest, (key[:cut], fp[:cut])], [(key[cut:], fp[cut:])]
            yield frame(links_of(np.concatenate([k for k, _ in whole]), np.concatenate([f for _, f in whole])))
        if rest:
            yield frame(links_of(np.concatenate([k for k, _ in rest]), np.concatenate([f for _, f in rest])))

    def frame(links: list[tuple[int, int]]) -> pd.DataFrame:
        a = np.array([x for x, _ in links], dtype=np.uint64).view(np.int64)
        b = np.array([y for _, y in links], dtype=np.uint64).view(np.int64)
        return pd.DataFrame({"a": a, "b": b})

    return run


def near_links(fps: DataFrame, max_distance: int, *, sample_rows: int = 2048, hot_bucket: int = 20_000, depth: int = 2) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fps`` (column fp) that connect all within ``max_distance``."""
    sample = np.array([r[0] for r in fps.orderBy(F.xxhash64(F.lit(1), "fp"), "fp").limit(sample_rows).collect()],
                      dtype=np.int64).view(np.uint64)
    masks = probe_masks(sample, max(1, fps.count()), max_distance)
    rows, done = filed(fps, masks), []
    for level in range(depth + 1):
        hot = checkpointed(rows.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > hot_bucket))
        n_hot = hot.count()
        if not n_hot:
            break
        hint = small_broadcast(hot, n_hot, 50_000)
        done.append(rows.join(hint, "key", "left_anti").select("key", "fp"))
        over = rows.join(hint, "key")
        if level == depth:
            rows = sliced(over, hot_bucket)
            break
        finer = {m: refined(m, max_distance + 1) for m in set(masks)}
        lookup = fps.sparkSession.createDataFrame(
            [(signed(m), [(signed(x), signed(m | x)) for x in xs]) for m, xs in finer.items()],
            "mask long, finer array<struct<bits:long,mask:long>>")
        over = over.join(F.broadcast(lookup), "mask").select("key", "fp", F.posexplode("finer").alias("i", "x"))
        rows = checkpointed(over.select(F.xxhash64("key", "i", F.col("fp").bitwiseAND(F.col("x.bits"))).alias("key"),
                                        F.col("x.mask").alias("mask"), "fp"))
        masks = [m | x for m, xs in finer.items() for x in xs]
    rows = rows.select("key", "fp")
    for d in done:
        rows = rows.unionByName(d)
    ordered = rows.repartition("key").sortWithinPartitions("key", "fp")
    return ordered.mapInPandas(bucket_links(max_distance), "a long, b long")


def sliced(over: DataFrame, hot_bucket: int) -> DataFrame:
    """Buckets that stay hot are cut into slices of ``hot_bucket`` rows, and every two slices meet in a bucket of their own."""
    n = F.ceil(F.col("n") / hot_bucket).cast("int")
    own = over.select("key", "fp", n.alias("n"), F.pmod(F.xxhash64(F.lit(2), "fp"), n).cast("int").alias("i"))
    met = own.select("key", "fp", "i", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("j"))
    return met.select(F.xxhash64("key", F.least("i", "j"), F.greatest("i", "j")).alias("key"), "fp")


def connected(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node, root the smallest of its component; by alternating stars."""
    def large(e: DataFrame) -> DataFrame:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()

    def small(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()

    edges = checkpointed(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct())
    before = None
    while True:
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        edges = checkpointed(small(large(edges)))


def components(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", shingle: int = 4, max_distance: int = 4,
               hot_share: int = 1000, **plan) -> DataFrame:
    """One row per document: ``id_col``, fp (signed long), root (smallest linked fp), component_id."""
    prints = checkpointed(docs.select(F.col(id_col).alias("id"), fingerprint_column(docs, F.col(text), shingle).alias("fp")))
    nodes = checkpointed(prints.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("n")))
    stars = connected(near_links(nodes.select("fp"), max_distance, **plan))
    rooted = nodes.join(stars, F.col("fp") == F.col("node"), "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root"))
    # materialised, so the join below shuffles both sides itself and Spark can split the root of a huge component
    least = checkpointed(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    final = checkpointed(rooted.join(least, "root").select("fp", "n", "root", "component_id"))
    # at most hot_share fingerprints can hold more than 1 / hot_share of all rows: those are looked up by broadcast
    total = nodes.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") * hot_share > total
    hot = F.broadcast(final.filter(is_hot).select("fp", F.struct("root", "component_id").alias("hot")))
    rows = prints.join(hot, "fp", "left")
    known = rows.filter(F.col("hot").isNotNull()).select("id", "fp", "hot.root", "hot.component_id")
    rest = rows.filter(F.col("hot").isNull()).select("id", "fp").join(final.filter(~is_hot).drop("n"), "fp")
    return known.unionByName(rest.select("id", "fp", "root", "component_id")).withColumnRenamed("id", id_col)


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", shingle: int = 4, max_distance: int = 4) -> DataFrame:
    """``docs`` with one row of each component: its smallest id, or any one row if all its ids are null."""
    found = checkpointed(components(docs, id_col=id_col, text=text, shingle=shingle, max_distance=max_distance))
    kept = found.filter(F.col(id_col) == F.col("component_id")).select(F.col(id_col).alias("__kept")).distinct()
    named = docs.filter(F.col(id_col).isNotNull()).join(kept, F.col(id_col) == F.col("__kept"), "left_semi").dropDuplicates([id_col])
    fp, root = fresh(docs, "__fp", "__root")
    roots = found.filter(F.col("component_id").isNull()).select(F.col("fp").alias(fp), F.col("root").alias(root)).distinct()
    blank = (docs.filter(F.col(id_col).isNull()).withColumn(fp, fingerprint_column(docs, F.col(text), shingle))
             .join(roots, fp).dropDuplicates([root]))
    return named.unionByName(blank.select(*own_columns(docs)))
