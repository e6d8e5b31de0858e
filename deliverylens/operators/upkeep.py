"""Upkeep of day-partitioned tables: late days rebuilt, covered days pruned, batches delivered or spilled."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .versions import Folder


def touched_days(events: DataFrame, late: DataFrame, day: str = "day", session: str = "trace_id") -> DataFrame:
    """(day) that late events touch: their own, and those of every session that they belong to."""
    mine = events.join(late.select(session).where(F.col(session).isNotNull()).distinct(), session, "left_semi")
    return mine.select(day).union(late.select(day)).distinct()


def rebuild_late(events: DataFrame, late: DataFrame, fold: Callable[[DataFrame], DataFrame], path: str, day: str = "day", session: str = "trace_id") -> int:
    """Rebuild the partitions of a table that late events touch, and no other; how many there are.

    ``events`` are all there are by now, the late ones among them. ``fold`` makes the table's rows, with their
    day, from whole sessions and may look at nothing beyond a session and a day; it gets
    every session that has an event on a touched day. Only these days' folders are replaced.
    """
    days = touched_days(events, late, day, session)
    sessions = events.join(days, day, "left_semi").select(session).distinct()
    whole = events.join(sessions, events[session].eqNullSafe(sessions[session]), "left_semi")
    rows = fold(whole).join(days, day, "left_semi")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)
    return days.count()


def prune(path: str, receipts: DataFrame, before: str, day: str = "day") -> list[str]:
    """Delete the day partitions older than ``before`` that a receipt covers; the days that went.

    receipts: (day, n): what an upload took of each day. A day is covered only if at least as many
    rows were taken as its partition has; any other survives, however old.
    """
    spark = receipts.sparkSession
    held = spark.read.parquet(path).groupBy(F.col(day).cast("date").alias("d")).agg(F.count("*").alias("held"))
    taken = receipts.groupBy(F.col("day").cast("date").alias("d")).agg(F.sum("n").alias("taken"))
    gone = held.join(taken, "d").where((F.col("taken") >= F.col("held")) & (F.col("d") < F.lit(before).cast("date")))
    days = sorted(str(r[0]) for r in gone.select("d").collect())  # a row a day
    folder = Folder(spark, path)
    for d in days:
        folder.delete(f"{day}={d}")
    return days


def deliver(send: Callable[[DataFrame], None], spill: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink that never stops its stream: a batch that can't be sent is spilled as JSON lines.

    A batch is spilled under its number, so one that is tried again replaces its own spill.
    """

    def put(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            send(batch)
        except Exception as error:  # fail open: the reason stays beside the rows
            why = f"{type(error).__name__}"
            batch.withColumn("spill_reason", F.lit(why)).write.mode("overwrite").json(f"{spill}/batch={number}")
        finally:
            batch.unpersist()

    return put


def resend(spark, send: Callable[[DataFrame], None], spill: str) -> int:
    """Send what was spilled, batch by batch; a batch that is sent goes, one that fails stays. How many went."""
    folder, sent = Folder(spark, spill), 0
    for name in folder.names():
        if name.startswith("batch="):
            rows = spark.read.json(f"{spill}/{name}").drop("spill_reason")
            try:
                send(rows)
            except Exception:
                continue
            folder.delete(name)
            sent += 1
    return sent


def write_findings(findings: DataFrame, path: str) -> None:
    """Findings of a day by their names, never by the values that gave them; a day that is written again is replaced."""
    rows = findings.select("detected_date", "check", "subject", F.col("severity"), F.col("n").cast("long"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("detected_date").json(path)
