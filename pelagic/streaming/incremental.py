"""Incremental ingest with Structured Streaming.

The source scripts are batch only (SURVEY §2.12: no streaming).  What can
run incrementally without changing results is offered here: the row-wise QC
operators (null folding, flag masks) and the depth-bin series, whose
per-(station, bin, hour) means are final once the watermark passes the hour.
Both use the same operators as the batch path; state and offsets live in
the shared checkpoint folder so a lost executor or driver restart resumes
exactly once.
"""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pelagic.functions.labels import depth_bin
from pelagic.functions.nulls import nan_to_null
from pelagic.operators.mooring import DEPTH_EDGES
from pelagic.operators.qc import mask_flags
from pelagic.session import checkpoint_dir


def _checkpoint(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark).rstrip("/"), "streams", name)


def qc_stream(spark: SparkSession, source_dir: str, schema: str, value_flag: Mapping[str, str],
              sink_path: str, name: str = "qc", available_now: bool = True) -> StreamingQuery:
    """Row-wise QC (S-06 + P-05) applied to new files of a parquet directory, appended to ``sink_path``."""
    s = spark.readStream.schema(schema).parquet(source_dir)
    out = mask_flags(nan_to_null(s), value_flag)
    w = (out.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", _checkpoint(spark, name)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(sink_path)


def depth_bin_stream(df: DataFrame, station: str, time: str, depth: str, temp: str,
                     watermark: str = "2 hours", bucket: str = "1 hour") -> DataFrame:
    """A-20 on a streaming DataFrame: mean per (station, depth bin, time bucket) with a watermark."""
    binned = df.withColumn("depth_bin", depth_bin(depth, DEPTH_EDGES)).where(F.col("depth_bin").isNotNull())
    t = F.col(time).cast("timestamp")
    return (binned.withColumn("__t", t).withWatermark("__t", watermark)
            .groupBy(station, "depth_bin", F.window("__t", bucket).alias("w"))
            .agg(F.avg(temp).alias(temp))
            .select(station, "depth_bin", F.col("w.start").alias("time"), temp))


def start_depth_bin_stream(spark: SparkSession, source_dir: str, schema: str, sink_path: str,
                           station: str, time: str, depth: str, temp: str, name: str = "depth_bins",
                           available_now: bool = True) -> StreamingQuery:
    """Run :func:`depth_bin_stream` from a parquet directory into a parquet sink (append mode)."""
    s = spark.readStream.schema(schema).parquet(source_dir)
    out = depth_bin_stream(s, station, time, depth, temp)
    w = (out.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", _checkpoint(spark, name)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(sink_path)
