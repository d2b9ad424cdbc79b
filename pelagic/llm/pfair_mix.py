"""Mixing sources to target weights by Pfair scheduling.

Documents of a source, in a seeded hash order, form blocks of ``block_docs``.
Slots of the mixture hold one block each.  The target of a source after t slots
is its weight's part of them; when a source has run out, the others' weights
are scaled up to 1, so every document is placed exactly once.  With v the target
of a source of weight 1 that never runs out, t(v) = sum of min(w * v, blocks)
over the sources.  A source's i-th block (from 0) is released at
floor(t(i / w)) with the deadline ceil(t((i + 1) / w)): floor(i / w) and
ceil((i + 1) / w) while no source has run out.  Earliest deadline first over the
released blocks meets every deadline, so after any number of slots, in any
phase, a source has had its target give or take less than one block.

Weights are exact fractions: a given 0.3 is 3 / 10, nothing is rounded.  The
driver goes through the schedule once and keeps only how many blocks each source
has had at the start of each range of slots; tasks schedule the ranges again
from there and write a row per block, which documents join.

Null sources are one source of their own.  Repeated rows are all placed.  The
driver holds one row per source (counts, weights) and range, never documents;
its time follows the number of blocks.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pelagic.llm.common import named_back, own_columns, set_aside, small_broadcast

NULL_SOURCE = "0"  # keys of named sources start with "1"
RANGES = 256  # at most so many ranges of slots


def edf_period(shares: dict[str, int]) -> dict[str, list[int]]:
    """Slots of each source in one period of A = sum(shares) slots, by earliest deadline first."""
    period = sum(shares.values())
    releases = sorted((i * period // a, -(-(i + 1) * period // a), s) for s, a in shares.items() for i in range(a))
    slots: dict[str, list[int]] = {s: [] for s in shares}
    ready: list[tuple[int, str]] = []
    at = 0
    for t in range(period):
        while at < len(releases) and releases[at][0] <= t:
            heapq.heappush(ready, releases[at][1:])
            at += 1
        slots[heapq.heappop(ready)[1]].append(t)
    return slots


def whole_shares(weights: dict[str, float], quantum: int) -> dict[str, int]:
    """Weights as whole numbers (at least 1 each) that add up to ``quantum`` or, for many sources, a little more."""
    total = sum(weights.values())
    shares = {s: max(1, math.floor(w / total * quantum)) for s, w in weights.items()}
    short = quantum - sum(shares.values())
    for s in sorted(weights, key=lambda s: (shares[s] - weights[s] / total * quantum, s))[:max(0, short)]:
        shares[s] += 1
    return shares


class Targets:
    """When each source is due its blocks, from exact weights (``shares`` are whole numbers)."""

    def __init__(self, blocks: list[int], shares: list[int]):
        self.blocks, self.shares = blocks, shares
        order = sorted(range(len(blocks)), key=lambda s: Fraction(blocks[s], shares[s]))
        self.out = [Fraction(blocks[s], shares[s]) for s in order]  # v at which the k-th source runs out
        self.gone, self.rate = [0], [sum(shares)]  # blocks of the sources that ran out, shares of the others
        for s in order:
            self.gone.append(self.gone[-1] + blocks[s])
            self.rate.append(self.rate[-1] - shares[s])
        self.phases = sorted({n + r * v for n, r, v in zip(self.gone, self.rate, self.out)})  # t at which sources run out

    def due(self, s: int, i: int, k: int) -> tuple[int, int, int]:
        """floor and ceil of t(i / w) of source ``s``, and how many sources have run out by then (``k`` at least)."""
        a = self.shares[s]
        if k < len(self.out) and i * self.out[k].denominator >= a * self.out[k].numerator:
            k = bisect_right(self.out, Fraction(i, a), lo=k)
        whole, part = divmod(self.rate[k] * i, a)
        return self.gone[k] + whole, self.gone[k] + whole + (part > 0), k


def schedule(targets: Targets, done: list[int], start: int, stop: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(source, block, release, deadline, slot) of the slots from ``start`` to ``stop``, counted in ``done``."""
    ready, later = [], []

    def add(s: int, k: int, t: int) -> None:
        release, _, k = targets.due(s, done[s], k)
        _, deadline, k = targets.due(s, done[s] + 1, k)
        if release <= t:
            heapq.heappush(ready, (deadline, s, release, k))
        else:
            heapq.heappush(later, (release, deadline, s, k))

    for s, n in enumerate(targets.blocks):
        if done[s] < n:
            add(s, 0, start)
    for t in range(start, stop):
        while later and later[0][0] <= t:
            release, deadline, s, k = heapq.heappop(later)
            heapq.heappush(ready, (deadline, s, release, k))
        deadline, s, release, k = heapq.heappop(ready)
        yield s, done[s], release, deadline, t
        done[s] += 1
        if done[s] < targets.blocks[s]:
            add(s, k, t + 1)


def whole_weights(weights: list[Fraction]) -> list[int]:
    """The same weights as whole numbers."""
    scale = math.lcm(*(w.denominator for w in weights))
    return [int(w * scale) for w in weights]


def range_starts(targets: Targets, slots: int) -> Iterator[tuple[int, int, bytes]]:
    """(first slot, slot after the last, blocks had by each source at the first) of ranges of ``slots`` slots."""
    total, done = sum(targets.blocks), [0] * len(targets.blocks)
    for start in range(0, total, slots):
        stop = min(total, start + slots)
        yield start, stop, np.array(done, dtype=np.int64).tobytes()
        for _ in schedule(targets, done, start, stop):
            pass


def placed_blocks(spark: SparkSession, keys: list[str], targets: Targets, slots: int) -> DataFrame:
    """A row per block: (__s, __b, __phase, __release, __deadline, __slot); each range is scheduled in a task of its own."""
    schema = "__s string, __b long, __phase int, __release long, __deadline long, __slot long"
    starts = list(range_starts(targets, slots))
    ranges = spark.createDataFrame(starts, "start long, stop long, done binary").repartition(max(1, len(starts)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["__s", "__b", "__phase", "__release", "__deadline", "__slot"]
        for b in batches:
            for r in b.to_pylist():
                rows = list(schedule(targets, np.frombuffer(r["done"], dtype=np.int64).tolist(), r["start"], r["stop"]))
                s, block, release, deadline, slot = zip(*rows)
                yield pa.RecordBatch.from_arrays([
                    pa.array([keys[x] for x in s], pa.string()), pa.array(block, pa.int64()),
                    pa.array([bisect_left(targets.phases, t + 1) for t in slot], pa.int32()),
                    pa.array(release, pa.int64()), pa.array(deadline, pa.int64()), pa.array(slot, pa.int64())], names=names)

    return ranges.mapInArrow(run, schema)


def target_weights(counts: dict[str, int], given: dict[str, float], power: float) -> dict[str, Fraction]:
    """The weight of each source as an exact fraction; a given 0.3 is 3 / 10, and 0 puts a source after the others."""
    exact = {s: Fraction(str(w)) or Fraction(1, 1 << 60) for s, w in given.items() if s in counts}
    rest = max(1 - sum(exact.values()), Fraction(1, 1000))
    size = {s: Fraction(float(n) ** power) for s, n in counts.items() if s not in exact}
    others = sum(size.values())
    return {s: exact[s] if s in exact else rest * size[s] / others for s in counts}


def source_key(source: Column) -> Column:
    return F.when(source.isNull(), F.lit(NULL_SOURCE)).otherwise(F.concat(F.lit("1"), source.cast("string")))


def numbered(docs: DataFrame, key: Column, order: Column, rows: int) -> DataFrame:
    """``docs`` with ``__s`` (source key) and ``__i``: place within the source in hash order, from 0.

    Places come from counts per (source, hash range) and a window inside one
    range, so no task sorts a whole source.
    """
    ranges = max(1, math.ceil(math.sqrt(rows) / 4))
    d = docs.withColumns({"__s": key, "__h": order})
    d = d.withColumn("__r", F.floor((F.col("__h") / F.lit(float(1 << 62))) * ranges).cast("int"))
    counts = d.groupBy("__s", "__r").agg(F.count("*").alias("__n"))
    before = counts.select("__s", "__r", (F.sum("__n").over(W.partitionBy("__s").orderBy("__r")) - F.col("__n")).alias("__before"))
    inside = F.row_number().over(W.partitionBy("__s", "__r").orderBy("__h", F.xxhash64(*own_columns(docs)))) - 1
    return (d.withColumn("__in", inside).join(before, ["__s", "__r"])
            .withColumn("__i", F.col("__before") + F.col("__in")).drop("__r", "__h", "__in", "__before"))


def pfair_mix(docs: DataFrame, weights: dict[str | None, float] | None = None, *, source: str = "source",
              id_col: str = "doc_id", block_docs: int = 8, quantum: int = 2048, power: float = 0.5, seed: int = 4,
              into: str = "mix") -> DataFrame:
    """All rows of ``docs`` with the struct ``into`` (phase, block, release, deadline, slot, position).

    ``weights``: share of the mixture per source.  Sources it leaves out (all, if
    None) divide the rest of 1, a thousandth at least, as their number of
    documents to the ``power``.  ``phase`` counts the times sources had run out.
    ``position`` orders the mixture.  Tasks schedule ``quantum`` slots at least.
    """
    spark = docs.sparkSession
    docs, now = set_aside(docs, "__s", "__i", "__h", "__r", "__n", "__in", "__before", "__b", "__phase", "__release", "__deadline", "__slot")
    key = source_key(F.col(f"`{now[source]}`"))
    order = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(f"`{now[id_col]}`").cast("string")), 2)
    counts = {r[0]: r[1] for r in docs.groupBy(key.alias("s")).agg(F.count("*").alias("n")).collect()}  # one row per source
    given = {NULL_SOURCE if s is None else f"1{s}": w for s, w in (weights or {}).items()}
    target = target_weights(counts, given, power)
    keys = sorted(counts)
    targets = Targets([-(-counts[s] // block_docs) for s in keys], whole_weights([target[s] for s in keys]))
    blocks = sum(targets.blocks)
    placed = placed_blocks(spark, keys, targets, max(quantum, 4 * len(keys), -(-blocks // RANGES)))
    d = numbered(docs, key, order, sum(counts.values())).withColumn("__b", F.floor(F.col("__i") / block_docs).cast("long"))
    d = d.join(small_broadcast(placed, blocks, 400_000), ["__s", "__b"])
    mixed = F.struct(
        F.col("__phase").alias("phase"), F.col("__b").alias("block"), F.col("__release").alias("release"),
        F.col("__deadline").alias("deadline"), F.col("__slot").alias("slot"),
        (F.col("__slot") * block_docs + F.col("__i") % block_docs).alias("position"))
    kept = {c: n for c, n in now.items() if c.lower() != into.lower()}
    return d.select(*named_back(kept), mixed.alias(into))
