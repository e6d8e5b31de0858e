"""Streaming runs over the stored events, held against the same result in batch SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deliverylens.sources.scratch import scratch

from .ingest import LATENESS, run_once, weekly_counts


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored events as a stream in the domain's names."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    raw = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{sf_dir}/events.parquet*")
    return raw.select(F.concat(F.lit("evt_"), "event_id").alias("event_id"), F.col("ts").cast("timestamp").alias("event_time"), "event_type", F.col("event_id").alias("n"))


def r02_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events delivered twice go in once: dedup within the watermark, exactly-once file sink."""
    twice = _events(spark, sf_dir).union(_events(spark, sf_dir).where("n % 10 = 0"))
    once = twice.withWatermark("event_time", LATENESS).dropDuplicatesWithinWatermark(["event_id"])
    out = scratch(spark, "events")
    run_once(once, out, scratch(spark, "state"))
    return spark.read.parquet(out).select("event_id", F.col("event_time").cast("timestamp_ntz").alias("event_time"), "event_type")


def r07_stream_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by Monday week and type over a stream, in update mode: the last value of each group."""
    out = scratch(spark, "weeks")

    def put(batch: DataFrame, epoch: int) -> None:
        batch.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    counts = weekly_counts(_events(spark, sf_dir).withWatermark("event_time", LATENESS))
    query = counts.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", scratch(spark, "state")).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.option("recursiveFileLookup", "true").parquet(out).groupBy("week", "event_type").agg(F.max_by("n", "epoch").alias("n"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"r02_stream_dedup": r02_stream_dedup, "r07_stream_weeks": r07_stream_weeks}
ORACLE_SQL = {
    "r02_stream_dedup": "SELECT concat('evt_', event_id) AS event_id, ts AS event_time, event_type FROM events",
    "r07_stream_weeks": "SELECT CAST(date_trunc('week', ts) AS DATE) AS week, event_type, count(*) AS n FROM events GROUP BY 1, 2",
}
