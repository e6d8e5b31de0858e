"""Readers of event files: NDJSON folders, weekly bundles, TSV sheets and request bodies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ACTOR = "person_id string, person_email_hash string, team_id string, role string"
CONTEXT = "jira_issue_key string, jira_project_key string, repo_full_name string, branch_name string, product_profile string, environment string, test_case_key string, test_cycle_key string"
AGENT = "agent_name string, agent_version string, skill_name string, skill_version string, surface string"
SCALARS = ("schema_version", "event_id", "event_type", "event_time", "ingested_at", "trace_id", "run_id", "parent_run_id", "span_id")
ENVELOPE = ", ".join(f"{s} string" for s in SCALARS) + f", actor struct<{ACTOR}>, context struct<{CONTEXT}>, agent struct<{AGENT}>, attributes string, link struct<method string, confidence double>"
MANIFEST = "format string, schema_version string, machine_id string, packed_at string, window_start string, window_end string, event_count bigint, sha256 string, sources map<string,boolean>"


def lines(spark: SparkSession, path: str, names: str = "*.ndjson") -> DataFrame:
    """(file, value): the lines of all files with such names below a folder."""
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", names).text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"), "value").where(F.trim("value") != "")


def parsed(raw: DataFrame, column: str = "value") -> DataFrame:
    """The envelope of each line as struct ``e``, null where the line is no JSON object."""
    e = F.from_json(column, ENVELOPE + ", bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"})
    return raw.withColumn("e", e).withColumn("e", F.when(F.col("e.bad").isNull() & F.ltrim(column).startswith("{"), F.col("e").dropFields("bad")))


def event_time(text: Column | str) -> Column:
    """A time from RFC 3339 text in any of its usual forms, else null; no zone means UTC."""
    return F.try_to_timestamp(F.regexp_replace(text, r"([+-]\d{2})(\d{2})$", "$1:$2"))


def flat(df: DataFrame, *more: str) -> DataFrame:
    """One column a field: scalars, the four blocks and the attributes' JSON text; further columns beside them."""
    blocks = [(b, f.split()[0]) for b, fields in (("actor", ACTOR), ("context", CONTEXT), ("agent", AGENT)) for f in fields.split(", ")]
    return df.select(
        *[event_time(f"e.{s}").alias(s) if s in ("event_time", "ingested_at") else F.col(f"e.{s}") for s in SCALARS],
        *[F.col(f"e.{b}.{f}") for b, f in blocks],
        F.col("e.link.method").alias("link_method"),
        F.col("e.link.confidence").alias("link_confidence"),
        F.col("e.attributes").alias("attributes"),
        *more,
    )


def read_events(spark: SparkSession, path: str, *, dedup: bool = True, need_time: bool = True, names: str = "*.ndjson") -> DataFrame:
    """The events of a folder; lines without an object, a type or (if needed) a time are left out."""
    from deliverylens.operators.dedup import keep_first

    good = flat(parsed(lines(spark, path, names)).where("e.event_type IS NOT NULL"))
    good = good.where("event_time IS NOT NULL") if need_time else good
    return keep_first(good) if dedup else good


def load_stats(spark: SparkSession, path: str, names: str = "*.ndjson") -> DataFrame:
    """One row: files, lines, malformed, no_type, no_timestamp and duplicates."""
    p = parsed(lines(spark, path, names)).withColumn("ok", F.col("e.event_type").isNotNull())
    return p.agg(
        F.count_distinct("file").alias("files"),
        F.count("*").alias("lines"),
        F.count_if(F.col("e").isNull()).alias("malformed"),
        F.count_if(F.col("e").isNotNull() & ~F.col("ok")).alias("no_type"),
        F.count_if(F.col("ok") & event_time("e.event_time").isNull()).alias("no_timestamp"),
        (F.count(F.when(F.col("ok"), F.col("e.event_id"))) - F.count_distinct(F.when(F.col("ok"), F.col("e.event_id")))).alias("duplicates"),
    )


def read_day_range(spark: SparkSession, path: str, since: str, until: str) -> DataFrame:
    """Days since..until, both included, of a buffer partitioned by event_date."""
    return spark.read.parquet(path).where(F.col("event_date").between(F.to_date(F.lit(since)), F.to_date(F.lit(until))))


def bundle_files(spark: SparkSession, path: str, names: str = "*.ndjson") -> DataFrame:
    """(file, digest, m, rows, fault) of bundle files, each read whole: a manifest line, then events.

    ``digest`` is that of the whole text; ``fault`` is null, or the first of
    not_a_manifest, wrong_format, wrong_major, count_mismatch and checksum_mismatch.
    Plain files are read as bytes, many times as fast as by the text reader where they are
    small; names that may be of packed files go through that, which unpacks them.
    """
    found = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", names)
    plain = names.endswith((".ndjson", ".txt"))
    files = found.format("binaryFile").load(path).withColumn("value", F.col("content").cast("string")) if plain else found.text(path, wholetext=True)
    files = files.select(F.col("_metadata.file_path").alias("file"), F.sha2("value", 256).alias("digest"), F.split("value", "\n", 2).alias("p"))
    head = F.from_json(F.col("p")[0], f"_manifest struct<{MANIFEST}>")["_manifest"]
    body = F.coalesce(F.get("p", F.lit(1)), F.lit(""))
    has = F.get_json_object(F.col("p")[0], "$._manifest").isNotNull()
    rows = F.filter(F.split("body", "\n"), lambda x: F.trim(x) != "")
    files = files.select("file", "digest", has.alias("has"), head.alias("m"), body.alias("body")).withColumn("rows", rows)
    fault = (
        F.when(~F.col("has"), "not_a_manifest")
        .when(~F.col("m.format").eqNullSafe("telemetry-bundle"), "wrong_format")
        .when(F.split_part("m.schema_version", F.lit("."), F.lit(1)) != "1", "wrong_major")
        .when(F.col("m.event_count") != F.size("rows"), "count_mismatch")
        .when(F.col("m.sha256") != F.sha2("body", 256), "checksum_mismatch")
    )
    return files.select("file", "digest", "m", "rows", fault.alias("fault"))


def read_bundles(spark: SparkSession, path: str, names: str = "*.ndjson") -> tuple[DataFrame, DataFrame]:
    """(manifests, events) of bundle files. Manifests have their fault; events of faulty bundles are left out."""
    files = bundle_files(spark, path, names)
    events = files.where("fault IS NULL").select("file", F.explode("rows").alias("value"))
    return files.select("file", "m.*", "fault", F.size("rows").alias("rows")), flat(parsed(events).where("e.event_type IS NOT NULL"))


def read_tsv(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """A tab-separated sheet; blank lines and comments go, missing cells are null."""
    raw = spark.read.text(path).where((F.trim("value") != "") & ~F.ltrim("value").startswith("#"))
    cells = F.split("value", "\t")
    return raw.select(*[F.nullif(F.trim(F.get(cells, F.lit(k))), F.lit("")).alias(n) for k, n in enumerate(names)])


def body_events(df: DataFrame, body: str = "body") -> DataFrame:
    """One row an event of request bodies that are an array, one object, or NDJSON."""
    b = F.trim(body)
    many = F.when(b.startswith("["), F.from_json(b, "array<string>")).otherwise(F.filter(F.split(b, r"\n(?=\s*\{)"), lambda x: F.trim(x) != ""))
    return parsed(df.select("*", F.explode(many).alias("value")))
