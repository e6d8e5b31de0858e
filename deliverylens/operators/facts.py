"""Facts of requests, builds and calls, and the column helpers, on the stored tables; each beside SQL of its own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deliverylens.functions import columns as C
from deliverylens.sources.events import event_time

from . import ingest, journal, review, tracker


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _pick(by: str, names: list[str | None]) -> Column:
    return F.array(*[F.lit(x) for x in names])[F.pmod(F.col(by), F.lit(len(names))).cast("int")]


def d02_comment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as requests, their lines as comments."""
    prs = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("pr_id"), F.concat(F.lit("p"), F.col("o_custkey") % 5).alias("author"))
    user = F.when(F.col("l_returnflag") == "R", "svc-build").otherwise(F.concat(F.lit("p"), F.col("l_suppkey") % 5))
    comments = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("pr_id"), user.alias("user"), (F.col("l_linestatus") == "F").alias("inline"), (F.col("l_quantity") < 5).alias("deleted"))
    out = review.comment_summary(prs, comments)
    return out.withColumn("by_person", F.array_join(F.transform(F.map_entries("by_person"), lambda x: F.concat(x["key"], F.lit("="), x["value"])), ","))


def d04_commit_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers' lines as commits of one request: the first 20 runs and 200 shas."""
    li = _t(spark, sf_dir, "lineitem")
    run = F.when(F.col("l_returnflag") != "N", F.concat(F.lit("r"), F.col("l_partkey") % 50))
    commits = li.select(F.col("l_suppkey").alias("pr_id"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("sha"), F.col("l_shipdate").alias("at"), run.alias("run_id"), (F.col("l_linestatus") == "F").alias("marked"))
    return review.commit_summary(commits).withColumn("run_ids", F.array_join("run_ids", ",")).withColumn("shas", F.array_join("shas", ","))


def d08_review_churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines after the first review; unknown if nobody reviewed or a commit's lines are unknown."""
    lines = F.when((F.col("l_returnflag") != "N") | (F.col("l_quantity") > 10), F.col("l_quantity").cast("long"))
    commits = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("pr_id"), F.col("l_shipdate").alias("at"), lines.alias("lines"))
    seen = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate") + F.expr("INTERVAL 300 DAYS"))
    return review.review_churn(commits, _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("pr_id"), seen.alias("first_review_at")))


def d13_builds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Builds with test reports of two shapes, or none; a negative duration is unknown."""
    o = _t(spark, sf_dir, "orders")
    report = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit('{"total": '), F.col("o_custkey") + 10, F.lit(', "failed": 3, "skipped": 2}')))
    report = report.when(F.col("o_orderstatus") == "O", F.concat(F.lit('{"passCount": '), "o_custkey", F.lit(', "failCount": 1}')))
    ended = F.col("o_orderdate") + F.make_dt_interval(mins=(F.col("o_custkey") % 7 - 1).cast("int"))
    builds = o.select(F.col("o_orderkey").alias("build_id"), _pick("o_orderkey", ["SUCCESSFUL", " failure", "ABORTED", "queued", None]).alias("state"), F.col("o_orderdate").alias("started_at"), ended.alias("ended_at"), report.alias("report"))
    return tracker.build_events(builds)


def d13_step_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps of a build; no known time stays unknown."""
    ms = F.when(F.col("l_returnflag") != "R", F.col("l_quantity").cast("long"))
    return tracker.step_totals(_t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("build_id"), ms.alias("duration_ms"), F.when(F.col("l_linestatus") == "F", "failed").otherwise("success").alias("status")))


def j23_call_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts and ends of calls of one id; calls of returned lines stay open."""
    li = _t(spark, sf_dir, "lineitem").withColumn("call", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey"))
    row = lambda kind, at: li.select(F.col("l_suppkey").alias("session_id"), "call", F.lit(kind).alias("kind"), at.cast("timestamp").alias("at"), F.col("l_linestatus").alias("status"), "l_returnflag")
    done = row("complete", F.col("l_shipdate") + F.make_dt_interval(secs=F.col("l_quantity").cast("decimal(18,6)"))).where("l_returnflag <> 'R'")
    pairs = journal.call_pairs(row("start", F.col("l_shipdate")).union(done).drop("l_returnflag"), "call", "at")
    return pairs.select("session_id", "call", "duration_ms", "status")


def i04_reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rule of the contract that an event breaks."""
    e = _events(spark, sf_dir)
    attrs = F.when(F.col("value") < 3, F.lit('{"note": {"Prompt": 1}}')).otherwise(F.col("props"))
    rows = e.select(
        _pick("user_id", ["1.0.0", "1.2.3", "2.0.0", "1.0", ""]).alias("schema_version"), F.concat(F.lit("e"), "event_id").alias("event_id"), F.when(F.col("event_type") == "view", "tool.call").when(F.col("event_type") == "click", "human.turn").when(F.col("event_type") == "error", "made.up").otherwise("run.started").alias("event_type"),
        F.col("ts").cast("string").alias("event_time_text"), F.when(F.col("event_type") != "signup", "t").alias("trace_id"), (F.col("event_type") != "purchase").alias("has_run_id"), attrs.alias("attributes"),
    )
    return rows.select(ingest.reject_reason(rows).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def i08_admitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted events: names outside the type's list go, values outside closed lists become null, each with a flag."""
    e = _events(spark, sf_dir)
    rows = e.select(
        F.lit("1.0.0").alias("schema_version"), F.concat(F.lit("e"), "event_id").alias("event_id"), F.when(F.col("event_type") == "view", "tool.call").otherwise("human.turn").alias("event_type"), F.when(F.col("event_type") != "signup", F.col("ts")).alias("event_time"), F.lit("t").alias("trace_id"),
        _pick("user_id", ["dev", "boss", None]).alias("role"), F.when(F.col("event_type") == "click", F.lit('{"k": "1", "zz": "2"}')).otherwise(F.col("props")).alias("attributes"), F.lit("x").alias("event_time_text"),
    )
    out = ingest.admit(rows, "2024-01-20 00:00:00", {"tool.call": ["k"], "human.turn": ["k"]})
    return out.groupBy("event_type", "role", "attributes", F.array_join("dq_flags", "|").alias("flags")).agg(F.count("*").alias("n"), F.date_format(F.max("event_time"), "yyyy-MM-dd HH").alias("last"), F.date_format(F.max("ingested_at"), "yyyy-MM-dd HH").alias("stamped"))


def f07_call_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as calls: unknown tokens or rates leave the price unknown, unknown cached tokens mean none."""
    li = _t(spark, sf_dir, "lineitem")
    tokens = (F.col("l_quantity") * 100).cast("long")
    cached = F.when(F.col("l_returnflag") == "A", F.col("l_linenumber") * 600)
    cost = C.price(F.when(F.col("l_returnflag") != "R", tokens), F.lit(500), cached, F.lit(3.0), F.lit(15.0), F.when(F.col("l_linestatus") == "F", 0.5))
    return li.groupBy("l_returnflag", "l_linestatus", "l_quantity", "l_linenumber").agg(F.count("*").alias("n"), F.round(F.max(cost), 6).alias("cost"))


def f22_event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times in the usual forms of RFC 3339, and what is none."""
    e = _events(spark, sf_dir)
    day = F.date_format("ts", "yyyy-MM-dd")
    hour = F.date_format("ts", "HH:mm:ss")
    text = F.when(F.col("event_type") == "view", F.concat(day, F.lit("T"), hour, F.lit("Z"))).when(F.col("event_type") == "click", F.concat(day, F.lit("T"), hour, F.lit("+0700"))).when(F.col("event_type") == "signup", F.concat(day, F.lit(" "), hour))
    text = text.when(F.col("event_type") == "purchase", F.concat(day, F.lit("T"), hour, F.lit(".250-03:30"))).otherwise("soon")
    return e.select("event_id", C.rfc3339(event_time(text)).alias("at"))


def f23_rfc3339(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select("event_id", C.rfc3339(F.col("ts")).alias("at"))


def f25_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epochs in seconds or milliseconds, told apart by size."""
    n = F.when(F.col("event_type").isin("view", "error"), F.unix_millis("ts")).otherwise(F.unix_seconds("ts"))
    return _events(spark, sf_dir).select("event_id", C.rfc3339(C.epoch(n)).alias("at"))


def f26_week_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO weeks with their bounds, over years with 52 and 53 of them."""
    o = _t(spark, sf_dir, "orders").select(C.iso_week(F.col("o_orderdate")).alias("week"), F.to_date("o_orderdate").alias("day"))
    first, last = C.week_bounds(F.col("week"))
    return o.groupBy("week", first.alias("first_day"), last.alias("last_day")).agg(F.count("*").alias("n"))


def f29_month_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    first, last = C.month_bounds(F.col("month"))
    return o.groupBy("month", first.alias("first_day"), last.alias("last_day")).agg(F.count("*").alias("n"))


def f31_test_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first case and the first cycle key of allowed projects over branch and title."""
    o = _t(spark, sf_dir, "orders")
    branch = F.concat(F.lit("fix/"), _pick("o_orderkey", ["IML", "SPRINT", "AUG"]), F.lit("-TC-"), F.col("o_custkey") % 4)
    title = F.concat(F.lit("run AUG-CY-"), F.col("o_custkey") % 3, F.lit(" for IML-TC-9 and IML-TC-10"))
    keys = C.test_keys([F.when(F.col("o_orderstatus") != "P", branch), title], ["IML", "AUG"])
    return o.select(keys["case_key"].alias("case_key"), keys["cycle_key"].alias("cycle_key")).groupBy("case_key", "cycle_key").agg(F.count("*").alias("n"))


def f51_guarded_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of dear events of a user's day, shown from five events on."""
    e = _t(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"), F.count_if(F.col("value") > 20).alias("dear"))
    return e.select("user_id", "day", F.round(C.k_guard(F.col("n"), C.rate(F.col("dear"), F.col("n"))), 1).alias("pct"))


def f56_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours to two places, rounded half to even; a missing one is told, never zero."""
    ms = F.when(F.col("l_returnflag") != "R", F.col("l_quantity").cast("long") * 450_000)
    return _t(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_quantity").agg(F.first(C.shown(C.hours(ms))).alias("hours"), F.count("*").alias("n"))


def a19_known_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of a user's day; unknown where no event has a status."""
    e = _t(spark, sf_dir, "events").withColumn("status", F.when(F.col("value") > 20, F.when(F.col("event_type") == "error", "error").otherwise("ok")))
    return e.groupBy("user_id", F.to_date("ts").alias("day")).agg(C.count_known(F.col("status"), F.col("status") == "error").alias("errors"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (d02_comment_summary, d04_commit_summary, d08_review_churn, d13_builds, d13_step_totals, j23_call_pairs, i04_reject_reasons, i08_admitted, f07_call_price, f22_event_times, f23_rfc3339, f25_epochs, f26_week_labels, f29_month_bounds, f31_test_keys, f51_guarded_rates, f56_hours, a19_known_errors)
}

ORACLE_SQL = {
    "d02_comment_summary": """
WITH c AS (SELECT l_orderkey AS pr_id, CASE WHEN l_returnflag = 'R' THEN 'build-ci' ELSE concat('p', l_suppkey % 5) END AS u, l_returnflag = 'R' AS bot, l_linestatus = 'F' AS inl, l_quantity < 5 AS del, l_suppkey % 5 = o_custkey % 5 AND l_returnflag <> 'R' AS own FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
p AS (SELECT pr_id, string_agg(u || '=' || n, ',' ORDER BY u) AS by_person FROM (SELECT pr_id, u, count(*) AS n FROM c WHERE NOT bot AND NOT del GROUP BY 1, 2) GROUP BY 1)
SELECT pr_id, count(*) FILTER (inl AND NOT del AND NOT bot) AS inline, count(*) FILTER (NOT inl AND NOT del AND NOT bot) AS top_level, count(*) FILTER (own AND NOT del) AS by_author, count(*) FILTER (bot) AS by_bots, count(*) FILTER (del) AS deleted, any_value(by_person) AS by_person FROM c LEFT JOIN p USING (pr_id) GROUP BY pr_id""",
    "d04_commit_summary": """
WITH c AS (SELECT l_suppkey AS pr_id, concat_ws('-', l_orderkey, l_linenumber, l_partkey) AS sha, l_shipdate AS moment, CASE WHEN l_returnflag <> 'N' THEN concat('r', l_partkey % 50) END AS run, l_linestatus = 'F' AS marked FROM lineitem),
r AS (SELECT pr_id, run, row_number() OVER (PARTITION BY pr_id ORDER BY min({'moment': moment, 'sha': sha, 'run': run})) AS nth FROM c WHERE run IS NOT NULL GROUP BY 1, 2),
s AS (SELECT pr_id, sha, row_number() OVER (PARTITION BY pr_id ORDER BY min(moment), sha) AS nth FROM c GROUP BY 1, 2)
SELECT pr_id, n AS commit_count, m AS ai_commits, coalesce(run_ids, '') AS run_ids, shas FROM (SELECT pr_id, count(*) AS n, count(*) FILTER (marked) AS m FROM c GROUP BY 1)
LEFT JOIN (SELECT pr_id, string_agg(run, ',' ORDER BY nth) AS run_ids FROM r WHERE nth <= 20 GROUP BY 1) USING (pr_id) JOIN (SELECT pr_id, string_agg(sha, ',' ORDER BY nth) AS shas FROM s WHERE nth <= 200 GROUP BY 1) USING (pr_id)""",
    "d08_review_churn": "SELECT l_orderkey AS pr_id, CASE WHEN max(o_orderstatus) <> 'P' AND count(*) FILTER (l_returnflag = 'N' AND l_quantity <= 10) = 0 THEN coalesce(sum(CAST(l_quantity AS BIGINT)) FILTER (l_shipdate > o_orderdate + INTERVAL 300 DAY), 0)::BIGINT END AS lines_after_review FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1",
    "d13_builds": "SELECT o_orderkey AS build_id, list_extract(['success', 'failed', 'cancelled', 'running', 'running'], CAST(o_orderkey % 5 AS INT) + 1) AS status, CASE WHEN o_custkey % 7 > 0 THEN (o_custkey % 7 - 1) * 60000 END AS duration_ms, CASE o_orderstatus WHEN 'F' THEN o_custkey + 10 WHEN 'O' THEN o_custkey + 1 END AS tests_total, CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'O' THEN 1 END::BIGINT AS tests_failed, CASE o_orderstatus WHEN 'F' THEN 2 END::BIGINT AS tests_skipped, CASE o_orderstatus WHEN 'F' THEN o_custkey + 5 WHEN 'O' THEN o_custkey END AS tests_passed FROM orders",
    "d13_step_totals": "SELECT l_orderkey AS build_id, count(*) AS steps, sum(CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity AS BIGINT) END)::BIGINT AS duration_ms, count(*) FILTER (l_linestatus = 'F') AS failed_steps FROM lineitem GROUP BY 1",
    "j23_call_pairs": "SELECT l_suppkey AS session_id, concat_ws('-', l_orderkey, l_linenumber, l_partkey) AS call, datediff('millisecond', min(l_shipdate), min(fin)) AS duration_ms, arg_min(l_linestatus, fin) AS status FROM (SELECT *, CASE WHEN l_returnflag <> 'R' THEN l_shipdate + to_seconds(CAST(l_quantity AS INT)) END AS fin FROM lineitem) GROUP BY 1, 2",
    "i04_reject_reasons": "SELECT CASE WHEN user_id % 5 = 4 THEN 'missing:schema_version' WHEN event_type = 'signup' THEN 'missing:trace_id' WHEN event_type = 'purchase' THEN 'missing:run_id' WHEN user_id % 5 >= 2 THEN 'schema_version' WHEN event_type = 'error' THEN 'event_type' WHEN value < 3 THEN 'forbidden:prompt' END AS reason, count(*) AS n FROM events GROUP BY 1",
    "i08_admitted": """
SELECT t AS event_type, CASE user_id % 3 WHEN 0 THEN 'dev' END AS role, a AS attributes, concat_ws('|', CASE WHEN late THEN 'DQ-10:event_time' END, CASE WHEN user_id % 3 = 1 THEN 'DQ-15:role' END, CASE WHEN event_type = 'click' THEN 'stripped:zz' END) AS flags,
  count(*) AS n, strftime(max(CASE WHEN late THEN TIMESTAMP '2024-01-20' ELSE ts END), '%Y-%m-%d %H') AS last, '2024-01-20 00' AS stamped
FROM (SELECT *, CASE WHEN event_type = 'view' THEN 'tool.call' ELSE 'human.turn' END AS t, CASE WHEN event_type = 'click' THEN '{"k":"1"}' ELSE props END AS a, event_type = 'signup' OR ts > TIMESTAMP '2024-01-20 00:05:00' AS late FROM events) GROUP BY 1, 2, 3, 4""",
    "f07_call_price": "SELECT l_returnflag, l_linestatus, l_quantity, l_linenumber, count(*) AS n, round(CASE l_returnflag WHEN 'N' THEN l_quantity * 0.3 + 7.5 WHEN 'A' THEN CASE WHEN l_linestatus = 'F' THEN greatest(l_quantity * 100 - l_linenumber * 600, 0) * 0.003 + 7.5 + l_linenumber * 0.3 END END, 6)::DOUBLE AS cost FROM lineitem GROUP BY 1, 2, 3, 4",
    "f22_event_times": "SELECT event_id, strftime(date_trunc('second', ts) + CASE event_type WHEN 'click' THEN INTERVAL '-7 hours' WHEN 'purchase' THEN INTERVAL '3 hours 30 minutes 250 milliseconds' WHEN 'error' THEN NULL ELSE INTERVAL '0 hours' END, '%Y-%m-%dT%H:%M:%S.%gZ') AS at FROM events",
    "f23_rfc3339": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS at FROM events",
    "f25_epochs": "SELECT event_id, strftime(CASE WHEN event_type IN ('view', 'error') THEN date_trunc('millisecond', ts) ELSE date_trunc('second', ts) END, '%Y-%m-%dT%H:%M:%S.%gZ') AS at FROM events",
    "f26_week_labels": "SELECT strftime(o_orderdate, '%G-W%V') AS week, CAST(date_trunc('week', o_orderdate) AS DATE) AS first_day, CAST(date_trunc('week', o_orderdate) AS DATE) + 6 AS last_day, count(*) AS n FROM orders GROUP BY 1, 2, 3",
    "f29_month_bounds": "SELECT strftime(o_orderdate, '%Y-%m') AS month, CAST(date_trunc('month', o_orderdate) AS DATE) AS first_day, last_day(CAST(o_orderdate AS DATE)) AS last_day, count(*) AS n FROM orders GROUP BY 1, 2, 3",
    "f31_test_keys": "SELECT CASE WHEN o_orderstatus <> 'P' AND o_orderkey % 3 <> 1 THEN concat(CASE WHEN o_orderkey % 3 = 0 THEN 'IML' ELSE 'AUG' END, '-TC-', o_custkey % 4) ELSE 'IML-TC-9' END AS case_key, concat('AUG-CY-', o_custkey % 3) AS cycle_key, count(*) AS n FROM orders GROUP BY 1, 2",
    "f51_guarded_rates": "SELECT user_id, CAST(ts AS DATE) AS day, CASE WHEN count(*) >= 5 THEN round(100.0::DOUBLE * count(*) FILTER (value > 20) / count(*), 1) END AS pct FROM events GROUP BY 1, 2",
    "f56_hours": "SELECT l_returnflag, l_quantity, CASE WHEN l_returnflag = 'R' THEN 'n/a' ELSE printf('%.2f', round_even(l_quantity * 0.125, 2)) END AS hours, count(*) AS n FROM lineitem GROUP BY 1, 2",
    "a19_known_errors": "SELECT user_id, CAST(ts AS DATE) AS day, CASE WHEN count(*) FILTER (value > 20) > 0 THEN count(*) FILTER (value > 20 AND event_type = 'error') END AS errors FROM events GROUP BY 1, 2",
}
