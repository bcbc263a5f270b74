"""Structured Streaming over the events."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sessions import STORE, closed_sessions, timed_sessions  # noqa: F401


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a file stream; ts becomes a timestamp, which watermarks need."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def daily_counts(events: DataFrame) -> DataFrame:
    """Events and their value by day and type; works on a stream and on a table alike."""
    return events.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,4)")).alias("total")).select(F.col("w.start").cast("timestamp_ntz").alias("day"), "event_type", "n", F.col("total").cast("double").alias("total"))


def windowed_counts(events: DataFrame, delay: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Events and their value by window and type, each window once the watermark is past its end; state ends with its window.

    Rows later than ``delay`` behind the latest one count only if their window is still open.
    """
    rows = events.withWatermark("ts", delay).groupBy(F.window("ts", width).alias("w"), "event_type")
    return rows.agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,4)")).alias("total")).select(F.col("w.start").cast("timestamp_ntz").alias("begun"), "event_type", "n", F.col("total").cast("double").alias("total"))


def event_pairs(earlier: DataFrame, later: DataFrame, within: str = "1 hour", delay: str = "1 hour", how: str = "inner") -> DataFrame:
    """event_id of each later event and earlier_id of each earlier one of the same user, at most ``within`` before it; both are streams.

    Watermarks on both sides and the bounds on the times let Spark drop a row's state once no row to come can meet it. With ``how``
    "left_outer" a later event that meets none comes with a null, when the watermark has passed it. Rows without a user or time meet nothing.
    """
    a = later.withWatermark("ts", delay).select("event_id", "user_id", "ts")
    b = earlier.withWatermark("ts", delay).select(F.col("event_id").alias("earlier_id"), F.col("user_id").alias("earlier_user"), F.col("ts").alias("earlier_ts"))
    near = F.expr(f"user_id = earlier_user and earlier_ts >= ts - interval {within} and earlier_ts <= ts")
    return a.join(b, near, how).select("event_id", "earlier_id")


def run_appended(result: DataFrame, spark: SparkSession) -> tuple[DataFrame, dict[str, int]]:
    """Runs a stream over what is there now in append mode; returns its rows as a table, and counts.

    The counts: rows dropped as later than the watermark, rows of state at the end, and the most at the end of any batch.
    """
    at = _folder(spark)
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, STORE)
    try:
        query = result.writeStream.outputMode("append").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).format("parquet").option("path", f"{at}/result").start()
        query.awaitTermination()
    finally:
        spark.conf.set(name, before)
    states = [s for p in query.recentProgress for s in p["stateOperators"]]
    counts = {"dropped": sum(s["numRowsDroppedByWatermark"] for s in states), "state": states[-1]["numRowsTotal"] if states else 0, "most_state": max((s["numRowsTotal"] for s in states), default=0)}
    return spark.read.schema(result.schema).parquet(f"{at}/result"), counts


def _folder(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        base = f"file://{tempfile.mkdtemp(prefix='spark-')}"
    return f"{base.rstrip('/')}/stream-{uuid.uuid4().hex}"


def run_to_end(result: DataFrame, spark: SparkSession) -> DataFrame:
    """Runs a stream over what is there now, keeping the complete result, and returns it as a table."""
    at = _folder(spark)

    def write(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(f"{at}/result")

    result.writeStream.outputMode("complete").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    return spark.read.schema(result.schema).parquet(f"{at}/result")
