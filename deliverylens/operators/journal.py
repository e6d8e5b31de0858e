"""Folds over a session journal: running state, call pairs, counters, fixes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_state(df: DataFrame, session: str, order: list[str], columns: list[str]) -> DataFrame:
    """Each record with the last value known of every column up to it."""
    w = Window.partitionBy(session).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.select("*", *[F.last(c, True).over(w).alias(f"current_{c}") for c in columns])


def call_pairs(df: DataFrame, call: str, at: str) -> DataFrame:
    """(session_id, call, started, ended, duration_ms, status) of tool calls; ended is null while open."""
    began = df.where("kind = 'start'").groupBy("session_id", call).agg(F.min(at).alias("started"))
    done = df.where("kind = 'complete'").groupBy("session_id", call).agg(F.min(at).alias("ended"), F.min_by("status", at).alias("status"))
    return began.join(done, ["session_id", call], "left").withColumn("duration_ms", F.expr("timestampdiff(MILLISECOND, started, ended)"))


def attempt_index(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return df.withColumn("attempt_index", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)


def first_fix(df: DataFrame, keys: list[str], order: list[str], status: str, bad: str, good: str) -> DataFrame:
    """The first good row right after a bad one, of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    found = df.withColumn("_before", F.lag(status).over(w)).where((F.col(status) == good) & (F.col("_before") == bad))
    return found.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth", "_before")
