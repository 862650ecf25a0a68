"""Streaming counterparts: sessions, latest state and windowed composites over a stream of observations."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stream_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table, one file or a folder of them, as a stream of the table's schema.

    The last character stands as a pattern, since a stream takes a plain path for a folder.
    """
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path[:-1]}[{path[-1]}]")


def session_counts(stream: DataFrame, key: str, ts: str, gap: str, late: str) -> DataFrame:
    """Sessions of a key by a gap in event time; rows later than the watermark are dropped by the engine."""
    timed = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    out = timed.groupBy(F.session_window("_ts", gap).alias("w"), F.col(key)).agg(F.count("*").alias("n"))
    return out.select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def window_best(stream: DataFrame, key: str, ts: str, value: str, width: str, late: str) -> DataFrame:
    """Greatest value of each tumbling window."""
    timed = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    out = timed.groupBy(F.window("_ts", width).alias("w"), F.col(key)).agg(F.max(value).alias("best"), F.count("*").alias("n"))
    return out.select(key, F.col("w.start").alias("win_start"), "best", "n")


def drain(result: DataFrame, spark: SparkSession, mode: str, root: str) -> DataFrame:
    """Run a stream over all that is there, write it to the shared folder and return what it wrote."""
    base = f"{root.rstrip('/')}/stream-{uuid.uuid4().hex}"
    if mode == "complete":
        def write(batch: DataFrame, n: int) -> None:
            batch.write.mode("overwrite").parquet(f"{base}/out")

        q = result.writeStream.outputMode("complete").foreachBatch(write)
    else:
        q = result.writeStream.outputMode(mode).format("parquet").option("path", f"{base}/out")
    q.option("checkpointLocation", f"{base}/log").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/out")
