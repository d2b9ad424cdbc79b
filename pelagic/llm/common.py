"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value of the contracts: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Documents may be megabytes long: rows of one Arrow batch of whole texts.
TEXT_BATCH_ROWS = 512
TEXT_BATCH_BYTES = 16 << 20


def own_columns(df: DataFrame) -> list[Column]:
    """The columns of ``df`` by name, whatever characters the names hold."""
    return [F.col(f"`{c}`") for c in df.columns]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """For each name one like it that no column of ``df`` bears (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def set_aside(df: DataFrame, *temporary: str) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with other names for its columns that bear a temporary one, and the name each column has there."""
    others = fresh(df, *temporary)
    clash = {t.lower(): o for t, o in zip(temporary, others)}
    now = {c: clash.get(c.lower(), c) for c in df.columns}
    return df.toDF(*now.values()), now


def named_back(now: dict[str, str]) -> list[Column]:
    """The columns that ``set_aside`` was given, under their own names."""
    return [F.col(f"`{n}`").alias(c) for c, n in now.items()]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, through Spark's reader only (the path may be remote)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z, everything else untouched."""
    return F.translate(c, UPPER, UPPER.lower())


def crc_mod(c: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (null for a null id)."""
    return F.pmod(F.crc32(c.cast("string")), F.lit(n))


def text_batches(spark: SparkSession, rows: int = TEXT_BATCH_ROWS) -> None:
    """Bound the rows and bytes of the session's Arrow batches so a batch of long texts fits a Python worker.

    Lowers the two settings where they are higher; it never raises them.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    had = str(spark.conf.get(key, "64m")).lower()
    if had in ("64m", "67108864b"):  # the default; a value the user chose stays
        spark.conf.set(key, f"{TEXT_BATCH_BYTES}b")


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that all executors share (``spark.checkpoint.dir``).

    Only a local session that names none gets a temporary folder; on a cluster that is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if d is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = os.path.join(tempfile.gettempdir(), "pelagic-llm-checkpoints")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder, so lost executors lose nothing."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def small_broadcast(df: DataFrame, rows: int, max_rows: int) -> DataFrame:
    """Broadcast ``df`` if its counted ``rows`` are within ``max_rows``; else leave the shuffle join to Spark."""
    return F.broadcast(df) if rows <= max_rows else df


def worker_cache(name: str, limit: int) -> "BoundedCache":
    """A cache that lives as long as the Python worker, shared by the tasks it runs."""
    c = _CACHES.get(name)
    if c is None:
        while len(_CACHES) >= 2:  # the oldest models are done with
            del _CACHES[next(iter(_CACHES))]
        c = _CACHES[name] = BoundedCache(limit)
    return c


class BoundedCache(dict):
    """A dict of two generations of ``limit`` entries: bounded memory, same answers.

    When the young one is full it becomes the old one; ``recall`` brings an old
    entry back, so what is used often is never computed twice.
    """

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.old = limit, {}

    def __setitem__(self, k, v):
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        super().__setitem__(k, v)

    def recall(self, k, default=None):
        """The old generation's entry, made young again."""
        got = self.old.get(k, default)
        if got is not default:
            self[k] = got
        return got


_CACHES: dict[str, BoundedCache] = {}
