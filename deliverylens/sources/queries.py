"""Readers and stores on files written from the stored tables, each beside SQL of its own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deliverylens.operators import store

from . import events, journal
from .scratch import scratch

WRITTEN = "*.txt"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _line() -> Column:
    """An event as a line of the contract's JSON."""
    at = F.when((F.col("event_type") == "click") & (F.col("value") > 50), "").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ssXXX"))
    return F.concat(F.lit('{"event_id":"evt_'), "event_id", F.lit('","event_type":"'), "event_type", F.lit('","event_time":"'), at, F.lit('","attributes":'), "props", F.lit("}"))


def _landed(spark: SparkSession, sf_dir: str) -> str:
    """A folder of lines, a file a day: errors are torn, purchases written twice,
    cheap sign-ups lack their type, dear clicks their time."""
    e = _t(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    untyped = (F.col("event_type") == "signup") & (F.col("value") < 10)
    text = F.when(F.col("event_type") == "error", F.substring(_line(), 1, 20)).when(untyped, F.regexp_replace(_line(), '"event_type"', '"kind"')).otherwise(_line())
    rows = e.select(F.explode(F.when(F.col("event_type") == "purchase", F.array(text, text)).otherwise(F.array(text))).alias("value"), F.to_date("ts").alias("day"))
    out = scratch(spark, "landed")
    rows.repartition("day").write.partitionBy("day").text(out)
    return out


def s05_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.load_stats(spark, _landed(spark, sf_dir), WRITTEN)


def s06_timeless_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events once each, those without a time kept."""
    got = events.read_events(spark, _landed(spark, sf_dir), need_time=False, names=WRITTEN)
    return got.groupBy("event_type").agg(F.count("*").alias("n"), F.count("event_time").alias("timed"))


def s07_lenient_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as they stand in the files, bad lines skipped, copies kept."""
    got = events.read_events(spark, _landed(spark, sf_dir), dedup=False, names=WRITTEN)
    return got.groupBy("event_type", F.to_date("event_time").alias("day")).agg(F.count("*").alias("n"), F.sum(F.get_json_object("attributes", "$.k").cast("long")).alias("k"))


def s09_bundle_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bundles written and read: those of odd weeks count wrong, those of week 4 have another body than they say."""
    e = _t(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("event_time"), F.col("event_type"))
    packed = store.pack_bundles(e, "m", 500)
    odd = F.substring("iso_week", -1, 1).cast("int") % 2
    says = F.when(F.col("iso_week") == "2024-W04", "0").otherwise(F.sha2(F.concat("body", F.lit("\n")), 256))
    head = F.to_json(F.struct(F.struct(F.lit("telemetry-bundle").alias("format"), F.lit("1.2.0").alias("schema_version"), F.col("iso_week").alias("window_start"), (F.col("event_count") + odd).alias("event_count"), says.alias("sha256")).alias("_manifest")))
    out = scratch(spark, "bundles")
    packed.select("iso_week", "part", F.concat(head, F.lit("\n"), "body").alias("value")).repartition("iso_week", "part").write.partitionBy("iso_week", "part").text(out)
    heads, body = events.read_bundles(spark, out, WRITTEN)
    read = body.groupBy("event_type").agg(F.count("*").alias("n"))
    faults = heads.groupBy(F.col("window_start").alias("name"), "fault").agg(F.sum("rows").cast("long").alias("n"))
    return faults.unionByName(read.select(F.col("event_type").alias("name"), F.lit("read").alias("fault"), "n"))


def s12_chat_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each request (a user's day) the last state and the last price that were written."""
    e = _t(spark, sf_dir, "events")
    rows = e.select(F.col("user_id").alias("session_id"), F.to_date("ts").alias("request_id"), F.col("event_id").alias("line_no"), F.col("event_type").alias("state"), F.when(F.col("event_type") == "purchase", F.col("value")).alias("price"))
    return journal.merge_chat(rows)


def s13_tool_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose fields have any of their known names; a path is no program."""
    o = _t(spark, sf_dir, "orders").withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    named = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit('{"timestamp":"'), "day", F.lit('T00:00:00Z","command":"git log -1","exit_code":0}')))
    named = named.when(F.col("o_orderstatus") == "O", F.concat(F.lit('{"ts":"'), F.unix_seconds(F.to_timestamp("day")), F.lit('","cmd":" ls","status":"2"}')))
    rows = o.select(named.otherwise(F.concat(F.lit('{"time":"'), F.unix_seconds(F.to_timestamp("day")), F.lit('000","original_cmd":"/usr/bin/make all","exit_code":"x"}'))).alias("value"))
    return journal.tool_history(rows).groupBy(F.to_date("at").alias("day"), "program", "exit_code").agg(F.count("*").alias("n"))


def s14_git_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commits with the last value of their trailers; a line without a colon is none."""
    o = _t(spark, sf_dir, "orders")
    text = F.concat("o_orderkey", F.lit("|c"), "o_custkey", F.lit("|"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00:00:00+0700|pay | refund\n\nRun-Id: r"), "o_custkey", F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("\nRUN-ID: last"), "o_orderkey")).otherwise("\nno trailer"))
    got = journal.git_log(o.select(text.alias("value")))
    return got.select("sha", "author", "subject", F.date_format("at", "yyyy-MM-dd HH:mm").alias("at"), F.col("trailers")["run-id"].alias("run_id"), F.size("trailers").alias("n_trailers"))


def s15_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Branch changes in a reflog; commits and detached heads are none."""
    e = _t(spark, sf_dir, "events")
    to = F.when(F.col("event_type") == "view", F.concat(F.lit("fix/"), "user_id")).when(F.col("event_type") == "click", F.repeat(F.lit("a0"), 20)).otherwise("main")
    text = F.when(F.col("event_type") == "error", "commit: checkout: moving from a to b").otherwise(F.concat(F.lit("checkout: moving from main to "), to))
    return journal.branch_timeline(e.select(F.col("user_id").alias("repo"), F.col("ts").alias("at"), text.alias("message"))).groupBy("repo", "branch").agg(F.count("*").alias("n"))


def s23_sheet_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tab-separated sheet: comments go, missing and empty cells are null."""
    c = _t(spark, sf_dir, "customer")
    row = F.concat_ws("\t", F.col("c_custkey").cast("string"), F.when(F.col("c_acctbal") < 0, " ").otherwise(F.col("c_name")), F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")))
    out = scratch(spark, "sheet")
    c.select(F.when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("  # "), row)).otherwise(row).alias("value")).write.text(out)
    return events.read_tsv(spark, out, ["person", "name", "segment"])


def s24_request_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies that are an array (views), several lines (clicks) or one object."""
    e = _t(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    body = F.when(F.col("event_type") == "view", F.concat(F.lit(" ["), _line(), F.lit(", "), _line(), F.lit("]"))).when(F.col("event_type") == "click", F.concat(_line(), F.lit("\n\n "), _line(), F.lit("\n"), _line())).otherwise(_line())
    got = events.body_events(e.select(body.alias("body")))
    return got.groupBy(F.col("e.event_type").alias("event_type")).agg(F.count("*").alias("n"), F.count_distinct("e.event_id").alias("events"))


def s26_day_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of a partitioned buffer, both ends included; other days' folders aren't read."""
    out = scratch(spark, "buffer")
    _t(spark, sf_dir, "events").withColumn("event_date", F.to_date("ts")).repartition("event_date").write.partitionBy("event_date").parquet(out)
    got = events.read_day_range(spark, out, "2024-01-10", "2024-01-19")
    return got.groupBy("event_date").agg(F.count("*").alias("n"))


def k03_rebuilt_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose days from the 15th on are rebuilt: days without new rows go, earlier ones stay."""
    e = _t(spark, sf_dir, "events").select("event_id", "event_type", F.to_date("ts").alias("day"))
    out = scratch(spark, "window")
    store.write_window(e, out)
    store.write_window(e.where("day BETWEEN DATE'2024-01-15' AND DATE'2024-01-20' AND event_type = 'purchase'"), out, since="2024-01-15")
    return spark.read.parquet(out).groupBy("day").agg(F.count("*").alias("n"))


def k05_replaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of one row, written a second time."""
    out = scratch(spark, "state")
    o = _t(spark, sf_dir, "orders")
    for rows in (o, o.where("o_orderstatus = 'F'")):
        store.replace_all(rows.agg(F.count("*").alias("n"), F.max("o_orderkey").alias("last_key")), out)
    return spark.read.parquet(out)


def k06_price_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A price book after a change that is taken and one that starts too early and is refused."""
    n = _t(spark, sf_dir, "nation")
    book = n.select(F.concat(F.lit("m_"), "n_nationkey").alias("model_id"), F.lit("2024-01-01").cast("date").alias("effective_from"), F.lit(None).cast("date").alias("effective_to"), F.col("n_regionkey").cast("double").alias("rate_in"))
    book = store.set_price(book, "m_3", "2024-06-01", {"rate_in": 7.5})
    book = store.set_price(book, "m_4", "2023-06-01", {"rate_in": 9.0})
    return store.set_price(book, "m_new", "2024-02-01", {})


def k08_kept_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"), "o_orderstatus")
    return store.expire(o, "day", "2001-09-01", 396).groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.min("day").alias("first_day"))


def k12_stored_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects (a user's day of one type) that aren't stored yet, under keys of their content."""
    e = _t(spark, sf_dir, "events").select("event_type", F.concat(F.lit("p"), "user_id").alias("person_id"), F.to_date("ts").cast("string").alias("iso_week"))
    objects = e.withColumn("machine_id", F.lit("machine-one")).withColumn("sha256", F.sha2(F.concat_ws("/", "event_type", "person_id", "iso_week"), 256))
    known = objects.where("event_type IN ('view', 'error')").select("sha256")
    return store.write_once(objects, known).select("key")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (s05_load_counts, s06_timeless_events, s07_lenient_lines, s09_bundle_read, s12_chat_requests, s13_tool_history, s14_git_log, s15_branches, s23_sheet_cells, s24_request_bodies, s26_day_range, k03_rebuilt_window, k05_replaced_table, k06_price_change, k08_kept_days, k12_stored_objects)
}

ORACLE_SQL = {
    "s05_load_counts": "SELECT count(DISTINCT CAST(ts AS DATE)) AS files, count(*) + count(*) FILTER (event_type = 'purchase') AS lines, count(*) FILTER (event_type = 'error') AS malformed, count(*) FILTER (event_type = 'signup' AND value < 10) AS no_type, count(*) FILTER (event_type = 'click' AND value > 50) AS no_timestamp, count(*) FILTER (event_type = 'purchase') AS duplicates FROM events",
    "s06_timeless_events": "SELECT event_type, count(*) AS n, count(*) FILTER (event_type <> 'click' OR value <= 50) AS timed FROM events WHERE event_type <> 'error' AND (event_type <> 'signup' OR value >= 10) GROUP BY event_type",
    "s07_lenient_lines": "SELECT event_type, CAST(ts AS DATE) AS day, sum(c)::BIGINT AS n, sum(c * CAST(props->>'$.k' AS BIGINT))::BIGINT AS k FROM (SELECT *, CASE event_type WHEN 'purchase' THEN 2 ELSE 1 END AS c FROM events) WHERE event_type <> 'error' AND NOT (event_type = 'signup' AND value < 10) AND NOT (event_type = 'click' AND value > 50) GROUP BY 1, 2",
    "s09_bundle_read": "WITH w AS (SELECT event_type, strftime(ts, '%G-W%V') AS wk FROM events), f AS (SELECT *, CASE WHEN CAST(right(wk, 1) AS INT) % 2 = 1 THEN 'count_mismatch' WHEN wk = '2024-W04' THEN 'checksum_mismatch' END AS fault FROM w) SELECT wk AS name, fault, count(*) AS n FROM f GROUP BY 1, 2 UNION ALL SELECT event_type, 'read', count(*) FROM f WHERE fault IS NULL GROUP BY 1",
    "s12_chat_requests": "SELECT user_id AS session_id, CAST(ts AS DATE) AS request_id, arg_max(event_type, event_id) AS state, arg_max(value, event_id) FILTER (event_type = 'purchase') AS price FROM events GROUP BY 1, 2",
    "s13_tool_history": "SELECT CAST(o_orderdate AS DATE) AS day, CASE o_orderstatus WHEN 'F' THEN 'git' WHEN 'O' THEN 'ls' END AS program, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 2 END AS exit_code, count(*) AS n FROM orders GROUP BY 1, 2, 3",
    "s14_git_log": "SELECT CAST(o_orderkey AS VARCHAR) AS sha, concat('c', o_custkey) AS author, 'pay | refund' AS subject, strftime(o_orderdate - INTERVAL 7 HOUR, '%Y-%m-%d %H:%M') AS at, CASE WHEN o_orderstatus = 'F' THEN concat('last', o_orderkey) ELSE concat('r', o_custkey) END AS run_id, 1 AS n_trailers FROM orders",
    "s15_branches": "SELECT user_id AS repo, CASE event_type WHEN 'view' THEN concat('fix/', user_id) ELSE 'main' END AS branch, count(*) AS n FROM events WHERE event_type NOT IN ('error', 'click') GROUP BY 1, 2",
    "s23_sheet_cells": "SELECT CAST(c_custkey AS VARCHAR) AS person, CASE WHEN c_acctbal >= 0 THEN c_name END AS name, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer WHERE c_mktsegment <> 'MACHINERY'",
    "s24_request_bodies": "SELECT event_type, count(*) * CASE event_type WHEN 'view' THEN 2 WHEN 'click' THEN 3 ELSE 1 END AS n, count(DISTINCT event_id) AS events FROM events GROUP BY event_type",
    "s26_day_range": "SELECT CAST(ts AS DATE) AS event_date, count(*) AS n FROM events WHERE ts >= '2024-01-10' AND ts < '2024-01-20' GROUP BY 1",
    "k03_rebuilt_window": "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE ts < '2024-01-15' OR (ts < '2024-01-21' AND event_type = 'purchase') GROUP BY 1",
    "k05_replaced_table": "SELECT count(*) AS n, max(o_orderkey) AS last_key FROM orders WHERE o_orderstatus = 'F'",
    "k06_price_change": "SELECT concat('m_', n_nationkey) AS model_id, DATE '2024-01-01' AS effective_from, CASE n_nationkey WHEN 3 THEN DATE '2024-05-31' END AS effective_to, CAST(n_regionkey AS DOUBLE) AS rate_in FROM nation UNION ALL VALUES ('m_3', DATE '2024-06-01', NULL, 7.5), ('m_new', DATE '2024-02-01', NULL, NULL)",
    "k08_kept_days": "SELECT o_orderstatus, count(*) AS n, CAST(min(o_orderdate) AS DATE) AS first_day FROM orders WHERE o_orderdate >= TIMESTAMP '2001-09-01' - INTERVAL 396 DAY GROUP BY 1",
    "k12_stored_objects": "SELECT DISTINCT concat('bundles/', d, '/p', user_id, '/machine--', sha256(concat(event_type, '/p', user_id, '/', d)), '.ndjson') AS key FROM (SELECT *, CAST(CAST(ts AS DATE) AS VARCHAR) AS d FROM events) WHERE event_type NOT IN ('view', 'error')",
}
