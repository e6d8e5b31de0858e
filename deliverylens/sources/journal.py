"""Readers of session journals, chat logs, tool histories and landed git output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .events import event_time


def read_journal(spark: SparkSession, path: str, modified_after: str | None = None) -> DataFrame:
    """(session_id, n, kind, at, data) of events.jsonl files, one folder a session.

    A torn last line, or any line that is no object, is left out; n orders the
    records of a session by time and then by text.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "events.jsonl")
    reader = reader.option("modifiedAfter", modified_after) if modified_after else reader
    raw = reader.text(path).select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/events\.jsonl$", 1).alias("session_id"), "value", F.col("_metadata.file_block_start").alias("block"))
    e = F.from_json("value", "type string, timestamp string, data string")
    good = raw.withColumn("e", e).where(F.col("e.type").isNotNull() & F.try_parse_json("value").isNotNull())
    return good.select("session_id", F.col("e.type").alias("kind"), event_time("e.timestamp").alias("at"), F.col("e.data").alias("data"))


def merge_chat(patches: DataFrame, key: str = "request_id", order: str = "line_no") -> DataFrame:
    """One row a request of an append-only patch log: of each field the last value written."""
    fields = [c for c in patches.columns if c not in ("session_id", key, order)]
    return patches.groupBy("session_id", key).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in fields])


def tool_history(df: DataFrame, column: str = "value") -> DataFrame:
    """(at, program, saved) of history records, whichever of their known names the fields have."""
    get = lambda *names: F.coalesce(*[F.get_json_object(column, f"$.{n}") for n in names])
    when = get("timestamp", "time", "ts")
    at = F.coalesce(event_time(when), F.when(when.rlike(r"^\d{9,10}$"), F.timestamp_seconds(when.try_cast("long"))), F.when(when.rlike(r"^\d{12,13}$"), F.timestamp_millis(when.try_cast("long"))))
    word = F.split_part(F.trim(get("command", "cmd", "original_cmd")), F.lit(" "), F.lit(1))
    return df.select(at.alias("at"), F.when((word != "") & ~word.rlike(r"[/\\]") & (F.length(word) <= 40), word).alias("program"), get("exit_code", "status").try_cast("int").alias("exit_code"))


def git_log(df: DataFrame, column: str = "value") -> DataFrame:
    """(sha, author, at, subject, trailers) of records ``sha|author|time|message``."""
    part = F.split(column, r"\|", 4)
    message = F.get(part, F.lit(3))
    lines = F.split(message, "\n")
    found = F.filter(F.slice(lines, 2, F.size(lines)), lambda x: x.rlike(r"^[A-Za-z][A-Za-z0-9-]*: "))
    pairs = F.transform(found, lambda x: F.struct(F.lower(F.split_part(x, F.lit(": "), F.lit(1))).alias("k"), F.regexp_extract(x, r"^[^:]+: (.*)$", 1).alias("v")))
    last = F.aggregate(pairs, F.create_map().cast("map<string,string>"), lambda m, p: F.map_concat(F.map_filter(m, lambda k, _: k != p["k"]), F.create_map(p["k"], p["v"])))
    return df.select(part[0].alias("sha"), F.get(part, F.lit(1)).alias("author"), event_time(F.get(part, F.lit(2))).alias("at"), lines[0].alias("subject"), last.alias("trailers"))


def branch_timeline(reflog: DataFrame) -> DataFrame:
    """(repo, branch, at) from reflog lines (repo, at, message): the branch after each checkout."""
    to = F.regexp_extract("message", r"^checkout: moving from \S+ to (\S+)$", 1)
    return reflog.select("repo", "at", to.alias("branch")).where((F.col("branch") != "") & ~F.col("branch").rlike("^[0-9a-f]{40}$"))
