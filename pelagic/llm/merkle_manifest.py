"""Merkle manifest of a dataset, with nested-interval labels.

A leaf is the digest of a row.  Rows are ranked by group and id: a range shuffle
of digests, whose partitions are counted, so no group is gathered.  Every node of
the tree carries the interval of leaf ranks it covers; a leaf covers its own rank.
Level by level, ``FAN`` consecutive nodes of a group become their parent, whose
digest is taken of their digests and whose interval is their union.  The top node
of a group covers the whole group; these subroots are the leaves of a second
tree, ordered like the groups, whose top is the root.

A proof needs a node's ancestors and their children.  A containment join of a
level with the next one, bucketed by the start of the interval that a parent of
that level would have, attaches to each node the one parent whose interval holds
its own.  The children of the parent whose intervals lie before or after the
node's own (the difference of the two) are its siblings.  Going down from the root
every level gains one step ``(before, after)``: the digests left and right of the
node.  Folding a leaf with its steps gives the root.

Digests are lower-case hex SHA-256; children are concatenated as hex text.  A
field counts as ``-`` if null, else as its bytes, ``:`` and its text.

* Null ids come first in their group, the null group comes first of all; groups
  are ordered bytewise.  Rows with equal ids are ordered by their leaf, equal
  leaves are interchangeable.  Every row is a leaf, repeated rows too.
* Texts of any length are hashed whole, where they are read; only digests move.
* An empty table gives an empty manifest.  Other columns are not read and can't
  clash; the columns of the result are named in ``manifest``.
* Levels are written to the shared folder, so lost executors lose nothing.  The
  driver holds one count per level and the root.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pelagic.llm.common import shared_folder

FAN = 8  # fixed value of the contract
SALTS = 32
ROW_BITS = 33  # monotonically_increasing_id: partition above, row inside the partition below


def field(c: Column) -> Column:
    """A field as it enters its row's digest."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(*fields: Column) -> Column:
    return F.sha2(F.concat(*[field(c) for c in fields]), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the steps of its proof give."""
    return F.aggregate(path, leaf, lambda own, s: F.sha2(F.concat(s["before"], own, s["after"]), 256))


def proof_digests(path: Column) -> Column:
    """The siblings' digests, from the leaf's level to the root's."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


class _Store:
    """Tables written once to the shared folder."""

    def __init__(self, spark):
        self.spark, self.folder, self.n = spark, f"{shared_folder(spark)}/merkle-{uuid.uuid4()}", 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.folder}/{self.n}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, order: list[str], store: _Store) -> DataFrame:
    """``df`` with ``lo``, the row's place (from 0) in ascending ``order``, nulls first.

    Range partitions sorted on their own, plus the rows of the partitions before.
    Rows that are equal in ``order`` are split among ranges by their input place.
    """
    by = [F.asc_nulls_first(c) for c in [*order, "__tie"]]
    laid = df.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    laid = store.keep(laid.drop("__tie").withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", ROW_BITS)
    counts = laid.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(W.orderBy("__part")) - F.col("__n")  # one row per partition
    starts = counts.select("__part", before.alias("__before"))
    placed = laid.withColumn("__part", part).join(F.broadcast(starts), "__part")
    return placed.withColumn("lo", F.col("__before") + F.col("__at").bitwiseAND((1 << ROW_BITS) - 1)).drop("__part", "__before", "__at")


def _bucket(level: int) -> Column:
    """Start of the interval that the node's parent, a node of ``level``, has."""
    size = FAN ** level
    return F.col("start") + F.floor((F.col("lo") - F.col("start")) / F.lit(size)).cast("long") * size


def grow(leaves: DataFrame, store: _Store) -> list[DataFrame]:
    """Levels 1.. of the trees over ``leaves`` (start, end, lo, hi, digest): the same columns plus ``kids``.

    ``start`` and ``end`` are the leaf ranks of the node's tree.  A tree ends at
    the level where one node covers it.
    """
    largest = leaves.agg(F.max(F.col("end") - F.col("start"))).first()[0] or 0
    levels, below = [], leaves
    while FAN ** len(levels) < largest:
        several = below.filter((F.col("lo") > F.col("start")) | (F.col("hi") < F.col("end")))
        kids = F.array_sort(F.collect_list(F.struct("lo", "hi", "digest")))
        up = several.groupBy("start", "end", _bucket(len(levels) + 1).alias("lo_up")).agg(kids.alias("kids"))
        hi = F.element_at("kids", -1)["hi"]
        digest = F.sha2(F.array_join(F.transform("kids", lambda k: k["digest"]), ""), 256)
        below = store.keep(up.select("start", "end", F.col("lo_up").alias("lo"), hi.alias("hi"), digest.alias("digest"), "kids"))
        levels.append(below)
    return levels


def tops(level: DataFrame) -> DataFrame:
    """The nodes that cover their whole tree."""
    return level.filter((F.col("lo") == F.col("start")) & (F.col("hi") == F.col("end"))).select("start", "end", "digest")


def attach(nodes: DataFrame, level: int, above: DataFrame | None, crown: DataFrame) -> DataFrame:
    """``nodes`` of ``level`` with ``subroot`` and ``path``, the steps from the node to the root.

    ``above``: the next level with both (None at the highest); ``crown``: subroot and path of each tree's top.
    """
    keep = [F.col(f"n.`{c}`") for c in nodes.columns]
    whole = (F.col("lo") == F.col("start")) & (F.col("hi") == F.col("end"))
    c = crown.select(F.col("start").alias("c_start"), "subroot", "path")
    out = nodes.filter(whole).alias("n").join(c, F.col("n.start") == F.col("c_start")).select(*keep, "subroot", "path")
    if above is None:
        return out
    p = above.select(F.col("start").alias("p_start"), F.col("lo").alias("p_lo"), F.col("hi").alias("p_hi"), "kids", "subroot", "path")
    child = nodes.filter(~whole).withColumn("bucket", _bucket(level + 1))
    held = (F.col("n.start") == F.col("p_start")) & (F.col("n.bucket") == F.col("p_lo")) \
        & (F.col("p_lo") <= F.col("n.lo")) & (F.col("n.hi") <= F.col("p_hi"))

    def digests(beside) -> Column:
        return F.array_join(F.transform(F.filter("p.kids", beside), lambda k: k["digest"]), "")

    step = F.struct(digests(lambda k: k["hi"] <= F.col("n.lo")).alias("before"), digests(lambda k: k["lo"] >= F.col("n.hi")).alias("after"))
    lower = child.alias("n").join(p.alias("p"), held).select(*keep, "p.subroot", F.concat(F.array(step), F.col("p.path")).alias("path"))
    return lower.unionByName(out)


def paths(leaves: DataFrame, levels: list[DataFrame], crown: DataFrame) -> DataFrame:
    """``leaves`` with ``subroot`` and ``path``: ancestors attached level by level, from the top down."""
    above = None
    for n in range(len(levels), 0, -1):
        above = attach(levels[n - 1], n, above, crown)
    return attach(leaves, 0, above, crown)


def manifest(docs: DataFrame, fields: list[str], group: str, order: str, carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``order``, ``group``, ``lo`` (its place), ``leaf``, ``subroot``, ``root``, ``path``.

    ``fields``: the columns that a leaf digests, in this order.  ``carry``: further
    columns, computed where the rows are read (such as a claimed leaf).
    """
    spark = docs.sparkSession
    store = _Store(spark)
    carry = carry or {}
    cols = [F.col(f"`{f}`") for f in fields]
    extra = [f"x{j}" for j in range(len(carry))]
    leaves = store.keep(docs.select(F.col(f"`{group}`").alias("g"), F.col(f"`{order}`").alias("o"), leaf_digest(*cols).alias("digest"),
                                    *[c.alias(x) for x, c in zip(extra, carry.values())]))
    leaves = ranked(leaves, ["g", "o", "digest"], store)

    # each group's interval; a hot group is met in SALTS parts
    spans = leaves.groupBy("g").agg(F.min("lo").alias("start"), (F.max("lo") + 1).alias("end"))
    spans = spans.select(F.col("g").alias("s_g"), "start", "end", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    same = F.col("g").eqNullSafe(F.col("s_g")) & (F.pmod(F.col("lo"), F.lit(SALTS)) == F.col("salt"))
    leaves = store.keep(leaves.join(spans, same).drop("s_g", "salt").withColumn("hi", F.col("lo") + 1))

    levels = grow(leaves, store)
    subroots = tops(leaves)
    for level in levels:
        subroots = subroots.unionByName(tops(level))
    trees = ranked(subroots.select("digest", F.col("start").alias("tree")), ["tree"], store)
    trees = store.keep(trees.select("tree", F.lit(0).cast("long").alias("start"), F.lit(subroots.count()).cast("long").alias("end"),
                                    "lo", (F.col("lo") + 1).alias("hi"), "digest"))
    high = grow(trees, store)
    top = tops(high[-1] if high else trees).first()
    root = F.lit(top["digest"] if top else None).cast("string")
    no_step = F.array().cast("array<struct<before:string,after:string>>")
    ground = spark.range(1).select(F.lit(0).cast("long").alias("start"), F.lit("").alias("subroot"), no_step.alias("path"))
    crown = paths(trees, high, ground).select(F.col("tree").alias("start"), F.col("digest").alias("subroot"), "path")

    out = paths(leaves, levels, store.keep(crown))
    return out.select(F.col("o").alias(order), F.col("g").alias(group), "lo", F.col("digest").alias("leaf"), "subroot", root.alias("root"),
                      "path", *[F.col(x).alias(name) for x, name in zip(extra, carry)])
