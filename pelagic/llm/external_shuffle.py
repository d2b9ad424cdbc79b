"""Sharding by a two-pass external shuffle.

Pass one scatters records into memory-sized buckets by seeded hashes: the shard
by the id, then a bucket inside the shard by the whole row and its copy number.
Pass two reads one bucket at a time, permutes it with a seeded Fisher-Yates
shuffle and numbers its records after those of the shard's earlier buckets.

The shard obeys the ``key`` law: it depends on the id and the number of shards
only (highest random weight), so one more shard takes records only into itself.

A bucket holds about ``bucket_bytes``; a shard has as many as the bytes counted
in it ask for, so an id with a third of all rows, or one row repeated as often,
fills many buckets.  Buckets grow where there would be more than
``most_buckets`` of them.  The copy number is the input partition and the
how-manieth of equal rows there: equal rows may change places freely, so the
order inside an input partition does not matter.

A null id is an id of its own: its records share a shard.  Null and empty texts
have no bytes.  Repeated rows all get their own slot.  A text of any length is
one record, whole.  An empty table gives no rows.  Columns named like the three
results are replaced; all others pass, whatever their names.  A lost executor
changes nothing: each bucket is sorted before it is permuted, and its seed is
its number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from pelagic.llm.common import fresh, own_columns, small_broadcast

LAW = "key"
SEED = 17
OUT_ROWS = 512  # rows of one batch that goes back to Spark
ROW_BYTES = 16  # fixed value of the contract: bytes of a record besides its text


def fisher_yates(n: int, *seed: int) -> np.ndarray:
    """A uniform permutation of 0..n-1."""
    order = list(range(n))
    draws = np.random.default_rng([s & 0xFFFFFFFF for s in seed]).random(max(n, 1))
    for i in range(n - 1, 0, -1):
        j = int(draws[i] * (i + 1))
        order[i], order[j] = order[j], order[i]
    return np.array(order, dtype=np.int64)


def shard_of(key: Column, shards: int, seed: int) -> Column:
    """The shard whose seeded hash of the key is highest."""
    weights = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)),
                          lambda k: F.struct(F.xxhash64(F.lit(seed), key, k).alias("w"), k.alias("k")))
    return F.array_max(weights)["k"].cast("int")


def record_bytes(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")


def copy_number(rows: Column) -> Column:
    """How many equal values of ``rows`` (hashes) came before in the input partition."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        seen: dict[int, int] = {}
        for hashes in batches:
            nth = hashes.groupby(hashes).cumcount().to_numpy()
            values = hashes.to_list()
            nth = nth + np.array([seen.get(v, 0) for v in values], dtype=np.int64)
            seen.update(zip(values, (nth + 1).tolist()))  # the last of equals counts
            yield pd.Series(nth)

    return run.asNondeterministic()(rows)


def bucket_counts(docs: DataFrame, shard: Column, shards: int, text: str, bucket_bytes: int, most_buckets: int) -> list[int]:
    """The number of buckets of each shard, by the bytes counted in it."""
    found = docs.groupBy(shard.alias("shard")).agg(F.sum(record_bytes(F.col(text))).alias("bytes")).collect()
    sizes = {r["shard"]: r["bytes"] for r in found}
    room = max(bucket_bytes, math.ceil(sum(sizes.values()) / most_buckets))
    return [max(1, math.ceil(sizes.get(k, 0) / room)) for k in range(shards)]


def external_shuffle(docs: DataFrame, shards: int, *, id_col: str = "doc_id", text: str = "text", seed: int = SEED,
                     bucket_bytes: int = 16 << 20, most_buckets: int = 200_000) -> DataFrame:
    """All columns of ``docs`` plus ``__shard``, ``__bucket`` and ``__slot`` (gapless from 0 in each shard)."""
    results = ("__shard", "__bucket", "__slot")
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in results])
    key, row, nth, place, n = fresh(docs, "__key", "__row", "__nth", "__place", "__n")
    own, key_text = own_columns(docs), F.col(f"`{id_col}`").cast("string")
    shard = shard_of(key_text, shards, seed)
    buckets = bucket_counts(docs, shard, shards, text, bucket_bytes, most_buckets)
    starts = [sum(buckets[:k]) for k in range(shards)]
    hashed = docs.withColumns({"__shard": shard, key: key_text, row: F.xxhash64(*own)})
    hashed = hashed.withColumn(nth, copy_number(F.col(row)))
    # a row without earlier copies goes by its hash alone, whichever partition it comes from
    copy = F.when(F.col(nth) == 0, F.lit(0)).otherwise(F.xxhash64(F.spark_partition_id(), F.col(nth)))
    within = F.pmod(F.xxhash64(F.lit(seed + 1), F.col(row), copy), F.get(F.lit(buckets), F.col("__shard")))
    spread = hashed.withColumn("__bucket", within.cast("int"))
    counts = spread.groupBy("__shard", "__bucket").agg(F.count("*").alias(n))
    first = counts.select("__shard", "__bucket",
                          (F.sum(n).over(W.partitionBy("__shard").orderBy("__bucket")) - F.col(n)).alias("__slot"))

    # one task per bucket: the partition id is the bucket's number
    dealt = spread.drop(nth).repartitionById(sum(buckets), (F.get(F.lit(starts), F.col("__shard")) + F.col("__bucket")).cast("int"))
    schema = StructType([*docs.schema.fields, StructField("__shard", IntegerType()), StructField("__bucket", IntegerType()),
                         StructField(place, LongType())])

    def permute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            t = pa.Table.from_batches(held).sort_by([(key, "ascending"), (row, "ascending")]).drop_columns([key, row])
            shard, bucket = t.column("__shard")[0].as_py(), t.column("__bucket")[0].as_py()
            order = fisher_yates(t.num_rows, seed, shard, bucket)
            for lo in range(0, len(order), OUT_ROWS):
                part = t.take(pa.array(order[lo:lo + OUT_ROWS]))
                places = pa.array(np.arange(lo, lo + part.num_rows))
                yield from part.append_column(place, places).combine_chunks().to_batches()

    mixed = dealt.mapInArrow(permute, schema)
    placed = mixed.join(small_broadcast(first, sum(buckets), most_buckets), ["__shard", "__bucket"])
    return placed.select(*own, "__shard", "__bucket", (F.col("__slot") + F.col(place)).alias("__slot"))


def write_shards(docs: DataFrame, path: str, shards: int, **options) -> None:
    """Write each shard as a folder ``shard=k``; a bucket is written by the task that shuffled it."""
    out = external_shuffle(docs, shards, **options)
    out.withColumnRenamed("__shard", "shard").withColumnRenamed("__slot", "slot").drop("__bucket").write.partitionBy("shard").parquet(path)
