"""Structured Streaming ingest: the batch plan over a stream of event files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from deliverylens.operators.ingest import admit
from deliverylens.sources.events import flat, parsed

LATENESS = "21 days"


def accepted(raw: DataFrame, now: str) -> DataFrame:
    """Accepted events of lines (value), batch or stream; repeated ids aren't dropped here."""
    good = flat(parsed(raw).where("e.event_type IS NOT NULL"))
    return admit(good, now).where("reject IS NULL").drop("reject")


def event_stream(spark: SparkSession, path: str, now: str, max_files: int = 96) -> DataFrame:
    """Accepted events of new files, each event_id once within the allowed lateness."""
    raw = spark.readStream.option("pathGlobFilter", "*.ndjson").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files).text(path)
    return accepted(raw, now).withWatermark("event_time", LATENESS).dropDuplicatesWithinWatermark(["event_id"])


def run_once(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Take in what is there, partitioned by day; the checkpoint is the high-water mark."""
    rows = stream.withColumn("event_date", F.to_date("event_time"))
    query = rows.writeStream.format("parquet").partitionBy("event_date").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def weekly_counts(stream: DataFrame) -> DataFrame:
    """Events by Monday week and type, for append or update mode."""
    week = F.window("event_time", "7 days", startTime="4 days")
    return stream.groupBy(week.alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.to_date("w.start").alias("week"), "event_type", "n")
