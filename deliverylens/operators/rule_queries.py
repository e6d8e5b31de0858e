"""Rules of reviews, links, labels and rollups called on rows made of the stored tables; each with SQL of its own."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deliverylens.functions import columns as C

from . import binding, review, temporal, tracker
from .state_queries import _RUNS_SQL, _events, _runs, _spans, _t


def _name(key: str, *names: str | None) -> Column:
    """One of the names by the key's remainder."""
    return F.array(*[F.lit(n) for n in names])[F.pmod(F.col(key), F.lit(len(names))).cast("int")]


def f36_bots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as accounts: names with hints in them, apps, and such as have neither name nor account."""
    c = _t(spark, sf_dir, "customer")
    name = _name("c_nationkey", "Ann Abbott", "Jenkins 2", "Deploy Pipelines", "svc-build", "build-ci", "Cy Young", "NoReply", None, " ")
    kind = F.when(F.col("c_mktsegment") == "BUILDING", "App").when(F.col("c_mktsegment") == "MACHINERY", "user")
    account = F.when(F.col("c_acctbal") > 0, F.concat(F.lit("acc"), "c_custkey"))
    return c.select("c_custkey", review.is_bot(name, kind, account).alias("is_bot"))


def d01_review_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as requests and their lines as actions: approvals, requested changes and comments of authors, reviewers, machines and nobody."""
    prs = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("pr_id"), F.concat(F.lit("p"), F.col("o_custkey") % 5).alias("author"))
    kind = F.when(F.col("l_returnflag") == "A", "approval").when(F.col("l_returnflag") == "R", "changes_requested").otherwise("comment")
    user = F.when(F.col("l_quantity") > 45, "renovate[bot]").when(F.col("l_quantity") >= 3, F.concat(F.lit("p"), F.col("l_suppkey") % 5))
    acts = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("pr_id"), kind.alias("kind"), F.col("l_shipdate").alias("at"), user.alias("user"), F.lit(None).cast("string").alias("state"))
    out = review.review_timeline(prs, acts)
    action = F.array_join(F.transform(F.array_sort(F.map_entries("actions")), lambda x: F.concat(x["key"], F.lit("="), x["value"])), ",")
    return out.select("pr_id", F.col("first_review_at").cast("timestamp_ntz").alias("first_review_at"), "first_reviewer", F.col("reviewer_count").cast("long").alias("reviewer_count"), F.col("approvals").cast("long").alias("approvals"), action.alias("actions"))


def d05_link_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as commits: none, one or two runs in their trailers, a marker, a key in the text."""
    li = _t(spark, sf_dir, "lineitem")
    runs = F.when(F.col("l_returnflag") == "A", F.array(F.concat(F.lit("r"), F.col("l_partkey")))).when((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 25), F.array(F.lit("r1"), F.lit("r2")))
    key = C.issue_key([F.when(F.col("l_quantity") < 10, F.concat(F.lit("fix IML-"), "l_suppkey")).otherwise("fix AUG-25")], ["IML"])
    x = li.select(review.link(runs, F.col("l_linestatus") == "F", key).alias("l"))
    return x.groupBy("l.method", "l.confidence", F.col("l.run_id").isNotNull().alias("one_run")).agg(F.count("*").alias("n"))


def d07_revert_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders are merges; urgent ones are reverted by full sha, high ones by an abbreviated one, others of a
    customer by the quoted subject, which is their customer's."""
    o = _t(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    sha = F.substring(F.sha2(F.col("o_orderkey").cast("string"), 256), 1, 40)
    subject = F.concat(F.lit("Change for "), "o_custkey")
    merges = o.select(F.col("o_orderkey").alias("pr_id"), F.lit("r").alias("repo"), F.col("o_orderdate").cast("timestamp").alias("merged_at"), sha.alias("sha"), subject.alias("subject"))
    low = F.substring("o_orderpriority", 1, 1)
    named = F.when(low == "1", sha).when(low == "2", F.substring(sha, 1, 12)).otherwise("0" * 12)
    reverts = o.where(low.isin("1", "2", "3")).select(F.concat(F.lit("v"), "o_orderkey").alias("revert_id"), F.lit("r").alias("repo"), (F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL 36 HOURS")).alias("at"), named.alias("sha"), subject.alias("subject"))
    return review.pair_reverts(reverts, merges)


def d11_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as issues, their lines as changes of status and of other fields."""
    issues = _t(spark, sf_dir, "orders").select(F.concat(F.lit("IML-"), "o_orderkey").alias("issue_key"), F.col("o_orderdate").alias("created_at"), F.col("o_orderstatus").alias("status"))
    field = F.when(F.col("l_quantity") < 40, "status").otherwise("assignee")
    changes = _t(spark, sf_dir, "lineitem").select(F.concat(F.lit("IML-"), "l_orderkey").alias("issue_key"), F.col("l_shipdate").alias("at"), field.alias("field"), F.col("l_linestatus").alias("from_value"), F.concat("l_returnflag", "l_linenumber", F.lit("-"), "l_partkey").alias("to_value"))
    out = tracker.status_transitions(issues, changes)
    return out.select("issue_key", F.col("at").cast("timestamp_ntz").alias("at"), "from_status", "to_status", "age_ms")


def d21_request_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of requests over branch, title and description: those of allowed projects, test keys masked."""
    o = _t(spark, sf_dir, "orders")
    branch = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("fix/IML-"), F.col("o_custkey") % 50)).when(F.col("o_orderstatus") == "O", F.concat(F.lit("fix/AUG-"), F.col("o_custkey") % 31)).otherwise("main")
    title = F.when(F.col("o_totalprice") > 150_000, F.concat(F.lit("IML-TC-"), F.col("o_custkey") % 9, F.lit(" title"))).otherwise("title")
    text = F.concat(F.lit("ERR-500 in OPS-"), F.col("o_custkey") % 11)
    key, tests = C.issue_key([branch, title, text], ["IML", "OPS"]), C.test_keys([branch, title, text], ["IML", "OPS"])
    return o.groupBy(key.alias("issue_key"), tests["case_key"].alias("case_key")).agg(F.count("*").alias("n"))


def f41_status_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test and build states of several spellings in their categories."""
    li = _t(spark, sf_dir, "lineitem")
    test = _name("l_partkey", "Passed", " FAIL ", "Not Applicable", "wip", "No Run", "odd", None)
    build = _name("l_suppkey", "SUCCESSFUL", "unstable", " Stopped", "queued", None)
    return li.groupBy(tracker.category(test, tracker.TEST_CATEGORIES, "other").alias("test"), tracker.category(build, tracker.BUILD_STATES, "running").alias("build")).agg(F.count("*").alias("n"))


def f46_priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by the label of their priority's second word."""
    name = F.nullif(F.split_part("o_orderpriority", F.lit("-"), F.lit(2)), F.lit("NOT SPECIFIED"))
    name = F.when(name == "URGENT", "Lowest").otherwise(name)
    return _t(spark, sf_dir, "orders").groupBy(C.priority_label(name).alias("priority")).agg(F.count("*").alias("n"))


def f47_size_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by the band of their lines' prices in thousands; orders without a line of a known status are unknown."""
    size = _t(spark, sf_dir, "lineitem").where("l_linestatus = 'F'").groupBy("l_orderkey").agg((F.sum("l_extendedprice") / 100).alias("lines"))
    o = _t(spark, sf_dir, "orders").join(size, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return o.groupBy(C.size_band(F.col("lines")).alias("band")).agg(F.count("*").alias("n"))


def h13_trend_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's weekly events over the whole weeks, as a word."""
    e = _events(spark, sf_dir).where("ts >= TIMESTAMP_NTZ '2024-01-01' AND ts < TIMESTAMP_NTZ '2024-01-29'")
    weeks = e.groupBy("user_id", F.trunc("ts", "week").alias("wk")).agg(F.count("*").alias("n")).groupBy("user_id")
    return weeks.agg(C.trend_word(F.transform(F.array_sort(F.collect_list(F.struct("wk", "n"))), lambda x: x["n"])).alias("word"))


def j14_overlapping_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each run with every earlier run of its user that is open at its start, past midnight too; null where none is. An open run lasts a day."""
    r = _runs(_events(spark, sf_dir)).withColumn("till", F.coalesce("ended_at", F.col("started_at") + F.expr("INTERVAL 24 HOURS")))
    return temporal.open_before(r, "run_id", "user_id", "started_at", "till").withColumnsRenamed({"open_before": "first_run", "run_id": "second_run"})


def w04_call_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one run of each call: the last of its session that began before it and isn't over, five minutes of grace on either side."""
    e = _events(spark, sf_dir)
    return binding.bind_spans(_spans(e), binding.run_windows(_runs(e), dt.date(9999, 1, 1))).select("span_id", "run_id")


def x10_span_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bound spans by run: purchases are chats and views tools; sums over chats alone, and their modal model."""
    e = _events(spark, sf_dir)
    day = F.date_format("ts", "yyyyMMdd")
    tokens = F.when(F.col("k") % 7 != 6, F.floor(F.col("v") * 100))
    spans = e.where("t IN ('purchase', 'view')").select(
        "n", F.concat(F.lit("evt_"), "n").alias("span_id"), F.concat_ws("_", F.lit("ses"), "user_id", day).alias("session"), F.col("ts").alias("start_time"),
        F.when(F.col("t") == "purchase", "chat").otherwise("execute_tool").alias("op"), F.when(F.col("k") % 8 == 1, "ERROR").otherwise("OK").alias("status"), tokens.alias("tokens"), F.concat(F.lit("m_"), F.col("k") % 5).alias("model"),
    )
    b = binding.bind_spans(spans, binding.run_windows(_runs(e), dt.date(2024, 1, 25)))
    chat, tool = F.col("op") == "chat", F.col("op") == "execute_tool"
    models = b.where(chat).groupBy("run_id", "model").agg(F.count("*").alias("c")).groupBy("run_id").agg(F.max_by("model", F.struct("c", (-F.substring("model", 3, 9).cast("int")).alias("o"))).alias("model_id"), F.count("*").alias("models"))
    total = b.groupBy("run_id").agg(F.count("*").alias("spans"), F.count_if(chat).alias("model_calls"), F.count_if(tool).alias("tool_calls"), F.count_if(tool & (F.col("status") == "ERROR")).alias("tool_errors"), F.sum(F.when(chat, F.col("tokens"))).alias("tokens_in"))
    return total.join(models, "run_id", "left").select("run_id", "spans", "model_calls", "tool_calls", "tool_errors", "tokens_in", "model_id", F.coalesce("models", F.lit(0)).alias("models"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    f36_bots, d01_review_timeline, d05_link_confidence, d07_revert_pairs, d11_transitions, d21_request_keys, f41_status_categories, f46_priorities, f47_size_band, h13_trend_words, j14_overlapping_intervals, w04_call_run, x10_span_rollup,
)}
_W = _RUNS_SQL.replace(" WHERE started_at < TIMESTAMP '2024-01-25'", "")
ORACLE_SQL = {
    "f36_bots": """
WITH a AS (SELECT c_custkey, lower(trim(coalesce(['Ann Abbott', 'Jenkins 2', 'Deploy Pipelines', 'svc-build', 'build-ci', 'Cy Young', 'NoReply', NULL, ' '][c_nationkey % 9 + 1], ''))) AS name, c_mktsegment = 'BUILDING' AS app, c_acctbal > 0 AS known FROM customer)
SELECT c_custkey, app OR name LIKE '%bot%' OR name LIKE '%jenkins%' OR name LIKE '%pipelines%' OR name LIKE '%svc-%' OR name LIKE '%noreply%' OR (name = '' AND NOT known) AS is_bot FROM a""",
    "d01_review_timeline": """
WITH a AS (SELECT l_orderkey AS pr_id, l_returnflag AS f, l_shipdate AS tm, concat('p', l_suppkey % 5) AS who FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_quantity BETWEEN 3 AND 45 AND l_suppkey % 5 <> o_custkey % 5),
r AS (SELECT pr_id, who, min(tm) AS tm, max(CASE f WHEN 'A' THEN 3 WHEN 'R' THEN 2 ELSE 1 END) AS s FROM a GROUP BY 1, 2)
SELECT o_orderkey AS pr_id, min(tm) AS first_review_at, arg_min(who, (tm, who)) AS first_reviewer, count(who) AS reviewer_count, count(*) FILTER (s = 3) AS approvals, string_agg(CASE WHEN who IS NOT NULL THEN concat(who, '=', CASE s WHEN 3 THEN 'approved' WHEN 2 THEN 'changes_requested' ELSE 'commented' END) END, ',' ORDER BY who) AS actions
FROM orders LEFT JOIN r ON o_orderkey = pr_id GROUP BY o_orderkey""",
    "d05_link_confidence": """
SELECT CASE WHEN l_returnflag = 'A' OR (l_returnflag = 'R' AND l_quantity > 25) THEN 'explicit' WHEN l_linestatus = 'F' THEN 'marker_only' WHEN l_quantity < 10 THEN 'heuristic' END AS method,
  CASE WHEN l_returnflag = 'A' OR (l_returnflag = 'R' AND l_quantity > 25) THEN 1.0 WHEN l_linestatus = 'F' THEN 0.3 WHEN l_quantity < 10 THEN 0.5 ELSE 0.0 END::DOUBLE AS confidence, l_returnflag = 'A' AS one_run, count(*) AS n FROM lineitem GROUP BY 1, 2, 3""",
    "d07_revert_pairs": """
WITH m AS (SELECT o_orderkey AS pr, o_custkey AS c, o_orderdate AS d, o_orderdate + INTERVAL 36 HOUR AS tm, substr(o_orderpriority, 1, 1) AS p FROM orders WHERE o_orderstatus = 'F'),
s AS (SELECT r.pr AS rev, arg_max(m.pr, (m.d, m.pr)) AS pr, max(m.d) AS d FROM m r JOIN m ON r.c = m.c AND m.d < r.tm WHERE r.p = '3' GROUP BY 1)
SELECT concat('v', m.pr) AS revert_id, CASE WHEN p IN ('1', '2') THEN m.pr ELSE s.pr END AS pr_id, CASE p WHEN '1' THEN 'sha' WHEN '2' THEN 'prefix' ELSE 'subject' END AS how, round(CASE WHEN p IN ('1', '2') THEN 1.5 ELSE (epoch_us(tm) - epoch_us(s.d)) / 86400000000.0 END, 4)::DOUBLE AS days
FROM m LEFT JOIN s ON s.rev = m.pr WHERE p IN ('1', '2', '3')""",
    "d11_transitions": """
WITH c AS (SELECT l_orderkey AS k, l_shipdate AS tm, l_linestatus AS f, concat(l_returnflag, l_linenumber, '-', l_partkey) AS t FROM lineitem WHERE l_quantity < 40),
b AS (SELECT k, arg_min(f, (tm, t)) AS was FROM c GROUP BY k)
SELECT concat('IML-', k) AS issue_key, tm AS at, f AS from_status, t AS to_status, CAST((epoch_us(tm) - epoch_us(o_orderdate)) / 1000 AS BIGINT) AS age_ms FROM c JOIN orders ON k = o_orderkey
UNION ALL SELECT concat('IML-', o_orderkey), o_orderdate, NULL, coalesce(was, o_orderstatus), 0 FROM orders LEFT JOIN b ON k = o_orderkey""",
    "d21_request_keys": "SELECT CASE WHEN o_orderstatus = 'F' THEN concat('IML-', o_custkey % 50) ELSE concat('OPS-', o_custkey % 11) END AS issue_key, CASE WHEN o_totalprice > 150000 THEN concat('IML-TC-', o_custkey % 9) END AS case_key, count(*) AS n FROM orders GROUP BY 1, 2",
    "f41_status_categories": "SELECT ['passed', 'failed', 'skipped', 'in_progress', 'not_run', 'other', 'other'][l_partkey % 7 + 1] AS test, ['success', 'failed', 'cancelled', 'running', 'running'][l_suppkey % 5 + 1] AS build, count(*) AS n FROM lineitem GROUP BY 1, 2",
    "f46_priorities": "SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'P4 (Lowest)' WHEN '2-HIGH' THEN 'P1 (HIGH)' WHEN '3-MEDIUM' THEN 'P2 (MEDIUM)' WHEN '5-LOW' THEN 'P3 (LOW)' ELSE 'unset' END AS priority, count(*) AS n FROM orders GROUP BY 1",
    "f47_size_band": "SELECT CASE WHEN s IS NULL THEN 'unknown' WHEN s < 10000 THEN 'S (<100)' WHEN s < 50000 THEN 'M (100-499)' WHEN s < 200000 THEN 'L (500-1999)' ELSE 'XL (2000+)' END AS band, count(*) AS n FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_extendedprice) AS s FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1) ON l_orderkey = o_orderkey GROUP BY 1",
    "h13_trend_words": """
WITH w AS (SELECT user_id, date_trunc('week', ts) AS wk, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-29' GROUP BY 1, 2),
s AS (SELECT user_id, n - lag(n) OVER (PARTITION BY user_id ORDER BY wk) AS step FROM w)
SELECT user_id, CASE WHEN count(*) < 2 THEN '-' WHEN count(*) FILTER (step > 0) > 0 AND count(*) FILTER (step < 0) > 0 THEN 'no clear trend' WHEN count(*) FILTER (step <> 0) = 0 THEN 'flat'
  ELSE concat(CASE WHEN count(*) FILTER (step > 0) > 0 THEN 'up' ELSE 'down' END, CASE WHEN count(*) > 2 THEN ' every week' ELSE '' END) END AS word FROM s GROUP BY user_id""",
    "j14_overlapping_intervals": f"""
WITH {_RUNS_SQL}
SELECT b.user_id, b.run_id AS second_run, b.started_at, a.run_id AS first_run FROM r b LEFT JOIN r a ON a.user_id = b.user_id AND a.started_at < b.started_at AND b.started_at <= coalesce(a.ended_at, a.started_at + INTERVAL 24 HOUR)""",
    "w04_call_run": f"WITH {_W} SELECT concat('evt_', n) AS span_id, arg_max(run_id, started_at) AS run_id FROM e JOIN w ON concat_ws('_', 'ses', e.user_id, strftime(ts, '%Y%m%d')) = session AND ts BETWEEN bind_from AND bind_to WHERE t = 'purchase' GROUP BY n",
    "x10_span_rollup": f"""
WITH {_RUNS_SQL}, s AS (SELECT n, arg_max(run_id, started_at) AS run_id FROM e JOIN w ON concat_ws('_', 'ses', e.user_id, strftime(ts, '%Y%m%d')) = session AND ts BETWEEN bind_from AND bind_to WHERE t IN ('purchase', 'view') GROUP BY n),
b AS (SELECT s.run_id, e.* FROM s JOIN e USING (n)),
m AS (SELECT run_id, k % 5 AS m, count(*) AS c FROM b WHERE t = 'purchase' GROUP BY 1, 2)
SELECT run_id, count(*) AS spans, count(*) FILTER (t = 'purchase') AS model_calls, count(*) FILTER (t = 'view') AS tool_calls, count(*) FILTER (t = 'view' AND k % 8 = 1) AS tool_errors, CAST(sum(CASE WHEN t = 'purchase' AND k % 7 <> 6 THEN floor(v * 100) END) AS BIGINT) AS tokens_in,
  (SELECT concat('m_', arg_max(m, (c, -m))) FROM m WHERE m.run_id = b.run_id HAVING count(*) > 0) AS model_id, (SELECT count(*) FROM m WHERE m.run_id = b.run_id) AS models FROM b GROUP BY run_id""",
}
