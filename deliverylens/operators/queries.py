"""Operators on the stored tables, each beside the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deliverylens.functions import columns as C

from . import dedup, ingest, journal, review, store, temporal, tracker


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def k01_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers after an upsert of a segment with a new balance, and some new ones."""
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    new = c.where("c_mktsegment = 'BUILDING'").withColumn("c_acctbal", F.lit(0.0))
    more = c.where("c_acctbal < 0").withColumn("c_custkey", F.col("c_custkey") + 10_000_000)
    return store.upsert(c, new.union(more), ["c_custkey"])


def k02_conditional_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders' states after an upsert: the time of change moves only with the state."""
    o = _t(spark, sf_dir, "orders")
    old = o.select("o_orderkey", F.col("o_orderstatus").alias("state"), F.col("o_orderdate").cast("date").alias("moved"))
    new = o.where("o_orderpriority IN ('1-URGENT', '2-HIGH')").select("o_orderkey", F.when(F.col("o_orderpriority") == "2-HIGH", "F").otherwise(F.col("o_orderstatus")).alias("state"), F.to_date(F.lit("2002-01-01")).alias("moved"))
    return store.upsert_on_change(old, new, ["o_orderkey"], "state", "moved")


def k10_append_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a batch that the buffer doesn't have yet."""
    e = _t(spark, sf_dir, "events").select("event_id", "event_type")
    return store.append_new(e.where("event_type IN ('view', 'click')"), e.where("event_type IN ('click', 'purchase')").unionAll(e.where("event_type = 'purchase'")))


def w01_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each user: a stock, not a flow."""
    e = _t(spark, sf_dir, "events")
    return dedup.latest(e, ["user_id"], "ts", "event_id").select("user_id", "event_id", "event_type")


def j06_effective_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the rate of their date from a book with two windows for each priority."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", F.col("o_orderdate").cast("date").alias("day"))
    book = spark.sql("SELECT p AS o_orderpriority, a AS effective_from, b AS effective_to, r AS rate FROM VALUES ('1-URGENT', date'1990-01-01', date'1997-12-31', 3), ('1-URGENT', date'1998-01-01', null, 4), ('2-HIGH', date'1996-06-01', date'1999-12-31', 2) AS t(p, a, b, r)")
    return temporal.effective(o, book, "o_orderpriority", "day").select("o_orderkey", "day", "rate")


def j14_overlapping_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a customer placed while an earlier one is open: finished ones for some days, partial ones without end."""
    o = _t(spark, sf_dir, "orders")
    until = F.when(F.col("o_orderstatus") != "P", F.date_add(F.col("o_orderdate").cast("date"), F.floor(F.col("o_totalprice") / 2000).cast("int")))
    rows = o.select("o_custkey", F.col("o_orderdate").cast("date").alias("placed"), until.alias("until"))
    return temporal.overlapped(rows, "o_custkey", "placed", "until")


def j08_as_of_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each click with the user's last purchase value at or before it."""
    e = _t(spark, sf_dir, "events")
    clicks = e.where("event_type = 'click'").select("user_id", F.col("ts").alias("at"), "event_id")
    buys = e.where("event_type = 'purchase'").groupBy("user_id", F.col("ts").alias("at")).agg(F.max("value").alias("value"))
    return temporal.as_of(clicks, buys, ["user_id"], "at", "value").select("event_id", F.col("value").alias("last_value"))


def w10_first_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first purchase right after an error, of each user."""
    e = _t(spark, sf_dir, "events")
    return journal.first_fix(e, ["user_id"], ["ts", "event_id"], "event_type", "error", "purchase").select("user_id", "event_id")


def w12_event_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _t(spark, sf_dir, "events")
    return journal.attempt_index(e, ["user_id", "event_type"], ["ts", "event_id"]).select("event_id", F.col("attempt_index").cast("long").alias("attempt_index"))


def w17_running_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The value in force as of each event: the last purchase of its user."""
    e = _t(spark, sf_dir, "events").withColumn("bought", F.when(F.col("event_type") == "purchase", F.col("value")))
    return journal.running_state(e, "user_id", ["ts", "event_id"], ["bought"]).select("event_id", "current_bought")


def i01_forbidden_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose attributes hold a forbidden name, at any depth."""
    e = _t(spark, sf_dir, "events")
    attrs = F.when(F.col("event_id") % 7 == 0, F.lit('{"a": {"Token": 1}}')).when(F.col("event_id") % 7 == 1, F.lit('{"input_tokens": 5, "note": "token"}')).otherwise(F.col("props"))
    hit = ingest.forbidden(attrs)
    return e.select("event_type", F.array_join(hit, ",").alias("names")).groupBy("event_type", "names").agg(F.count("*").alias("n"))


def f44_salted_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _t(spark, sf_dir, "customer")
    return c.select("c_custkey", C.email_hash(F.concat(F.lit(" "), "c_name", F.lit("@X.org")), "pepper").alias("mail_hash"))


def a28_nearest_rank_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest-rank 85th percentile of order totals by status, rank rounded half to even."""
    return C.nearest_rank(_t(spark, sf_dir, "orders"), ["o_orderstatus"], "o_totalprice", 0.85, "p85")


def f30_issue_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first allowed key over branch and title; test-case keys are masked."""
    o = _t(spark, sf_dir, "orders")
    branch = F.concat(F.lit("fix/AUG-"), F.col("o_orderkey") % 30)
    title = F.concat(F.lit("IML-TC-"), F.col("o_orderkey") % 9, F.lit(" blocks IML-"), F.col("o_custkey") % 50)
    return o.select(C.issue_key([branch, title], ["IML"]).alias("issue_key")).groupBy("issue_key").agg(F.count("*").alias("n"))


def d03_path_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of requests by automation kind: the first pattern that fits."""
    o = _t(spark, sf_dir, "orders")
    paths = ["features/a/API.feature", "features/step-definitions/login.steps.ts", "tests/login.spec.ts", "test_api.py", "src/pages/LoginPage.ts", "tests/data/payload.json", "package.json", "steps/notes.md", "MyTest.java", "mocks/x.csv", "src/test.go"]
    path = F.array(*[F.lit(p) for p in paths])[F.col("o_orderkey") % len(paths)]
    return o.select(review.first_match(path, review.AUTOMATION_KINDS).alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


def d06_decline_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders").where("o_orderstatus = 'P'")
    by = F.when(F.col("o_orderkey") % 4 != 2, F.col("o_custkey") + F.col("o_orderkey") % 4)
    return o.select("o_orderkey", review.decline_reason(by, F.col("o_custkey"), F.col("o_orderkey") % 7 == 1).alias("reason"))


def d10_attributed_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature that each order, seen as an issue, delivers: its lines are links, its customer the parent."""
    o = _t(spark, sf_dir, "orders")
    issues = o.select(F.concat(F.lit("A-"), "o_orderkey").alias("issue_key"), F.when(F.col("o_custkey") % 3 != 0, F.concat(F.when(F.col("o_custkey") % 3 == 1, "A-").otherwise("B-"), "o_custkey")).alias("parent_key"))
    names = F.array(*[F.lit(x) for x in ("Relates to", "tests", "clones", "blocks", "duplicates")])
    li = _t(spark, sf_dir, "lineitem").where("l_quantity < 9")
    links = li.select(F.concat(F.lit("A-"), "l_orderkey").alias("issue_key"), F.col("l_linenumber").alias("nth"), F.concat(F.when(F.col("l_partkey") % 2 == 0, "A-").otherwise("C-"), "l_partkey").alias("target_key"), names[(F.col("l_partkey") % 5).cast("int")].alias("link_type"))
    return tracker.attributed_issue(issues, links)


def d12_test_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test runs by category of their status; a run that never ran has no time."""
    o = _t(spark, sf_dir, "orders")
    names = ["Passed", " fail ", "N/A", "wip", "NotRun", "custom", "", "Blocked"]
    status = F.array(*[F.lit(x) for x in names])[F.col("o_orderkey") % len(names)]
    runs = o.select(status.alias("status"), F.col("o_orderdate").alias("executed_at"), F.lit(None).cast("array<string>").alias("defects"))
    return tracker.test_runs(runs).groupBy("status_category").agg(F.count("*").alias("n"), F.count("executed_at").alias("timed"))


def f39_gates_and_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commands to gates, messages to error classes, exit codes from the last line only."""
    e = _t(spark, sf_dir, "events")
    pick = lambda xs: F.array(*[F.lit(x) for x in xs])[(F.col("event_id") % len(xs)).cast("int")]
    cmd = pick(["npm run test", "ruff check .", "cargo build", "gitleaks detect", "ls -la", "python -m pytest -q"])
    msg = pick(["Permission denied", "no match found for x", "multiple matches", "path is required", "Timed out", "boom", None])
    out = pick(["ok <exited with exit code 0>", "<exited with exit code 7> and more", "bad\n<exited with exit code -2>  \n"])
    return e.select(C.gate_of(cmd).alias("gate"), C.error_class(msg).alias("error"), C.exit_code(out).alias("code")).groupBy("gate", "error", "code").agg(F.count("*").alias("n"))


def f40_tool_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _t(spark, sf_dir, "events")
    name = F.array(*[F.lit(x) for x in ("bash", "view", "grep", "web_fetch", "task", "mystery")])[(F.col("event_id") % 6).cast("int")]
    return e.select(C.tool_kind(name, F.when(F.col("user_id") % 4 == 0, "srv")).alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


def f42_build_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders")
    name = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit(" Build"), F.col("o_custkey") % 5, F.lit(" » release/"), F.col("o_custkey") % 3, F.lit(" #"), "o_orderkey")).when(F.col("o_orderkey") % 3 == 1, F.lit("plain job"))
    b = C.build_name(name)
    return o.select(b["job"].alias("job"), b["branch"].alias("branch"), b["number"].alias("number")).groupBy("job", "branch").agg(F.count("*").alias("n"), F.count("number").alias("numbered"))


def i09_extra_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that an importer rejects: their attributes hold a name that the type's list lacks."""
    attrs = F.when(F.col("event_id") % 3 == 0, F.lit('{"k": 1, "zz": 2, "aa": 3}')).otherwise(F.col("props"))
    e = _t(spark, sf_dir, "events").select("event_type", attrs.alias("attributes"))
    extra = ingest.extra_attributes({"view": ["k"], "click": ["k", "zz"]})
    return e.select("event_type", F.array_join(extra, ",").alias("extra")).where("extra <> ''").groupBy("event_type", "extra").agg(F.count("*").alias("n"))


def i11_clamped_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Future times and negative spans become null and leave a flag."""
    e = _t(spark, sf_dir, "events").select("event_id", F.col("ts").alias("ended_at"), (F.col("event_id") % 7 - 2).alias("duration_ms"))
    out = ingest.clamp_times(e, ["ended_at"], "2024-01-20 00:00:00", ["duration_ms"])
    return out.select("event_id", "ended_at", "duration_ms", F.array_join("clock_flags", ",").alias("flags"))


def i15_relative_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _t(spark, sf_dir, "events")
    path = F.concat(F.array(*[F.lit(x) for x in ("/w/repo/", "/w/repo/sub/", "src/", "/etc/", "C:\\x\\")])[(F.col("event_id") % 5).cast("int")], F.lit("f.ts"))
    return e.select(ingest.relative_path(path, ["/w/repo", "/w/repo/sub/"]).alias("path")).groupBy("path").agg(F.count("*").alias("n"))


def i17_sheet_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a sheet with their faults, none dropped."""
    o = _t(spark, sf_dir, "orders")
    rows = o.select(F.when(F.col("o_orderkey") % 5 > 0, F.col("o_clerk") if "o_clerk" in o.columns else F.lit("x")).alias("name"), F.array(*[F.lit(x) for x in ("8", "25", "-1", "many", None)])[(F.col("o_orderkey") % 5).cast("int")].alias("hours"), F.array(*[F.lit(x) for x in ("2024-02-29", "2023-02-29", "soon")])[(F.col("o_orderkey") % 3).cast("int")].alias("day"))
    out = ingest.sheet_faults(rows, ["name"], "hours", "day")
    return out.select(F.array_join("faults", "; ").alias("faults")).groupBy("faults").agg(F.count("*").alias("n"))


def k11_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bundles by ISO week: a long week has several parts."""
    e = _t(spark, sf_dir, "events").select("event_id", F.col("ts").alias("event_time"))
    out = store.pack_bundles(e, "m", 500)
    return out.groupBy("iso_week").agg(F.sum("event_count").alias("n"), F.sum(F.size(F.split("body", "\n"))).alias("lines"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (k01_upsert, k02_conditional_upsert, k10_append_new, w01_latest_state, j06_effective_segments, j14_overlapping_orders, j08_as_of_purchase, w10_first_recovery, w12_event_index, w17_running_purchase, i01_forbidden_keys, f44_salted_hash, a28_nearest_rank_value, f30_issue_keys, d03_path_kinds, d06_decline_reason, d10_attributed_issues, d12_test_runs, f39_gates_and_errors, f40_tool_kinds, f42_build_names, i09_extra_attributes, i11_clamped_times, i15_relative_paths, i17_sheet_faults, k11_bundles)}

ORACLE_SQL = {
    "k01_upsert": "SELECT c_custkey, c_mktsegment, CASE WHEN c_mktsegment = 'BUILDING' THEN 0.0::DOUBLE ELSE c_acctbal END AS c_acctbal FROM customer UNION ALL SELECT c_custkey + 10000000, c_mktsegment, c_acctbal FROM customer WHERE c_acctbal < 0",
    "k02_conditional_upsert": "SELECT o_orderkey, CASE WHEN o_orderpriority = '2-HIGH' THEN 'F' ELSE o_orderstatus END AS state, CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus <> 'F' THEN DATE '2002-01-01' ELSE CAST(o_orderdate AS DATE) END AS moved FROM orders",
    "k10_append_new": "SELECT event_id, event_type FROM events WHERE event_type = 'purchase'",
    "w01_latest_state": "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS nth FROM events) WHERE nth = 1",
    "j06_effective_segments": "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, b.r AS rate FROM orders LEFT JOIN (VALUES ('1-URGENT', DATE '1990-01-01', DATE '1997-12-31', 3), ('1-URGENT', DATE '1998-01-01', CAST(NULL AS DATE), 4), ('2-HIGH', DATE '1996-06-01', DATE '1999-12-31', 2)) AS b(p, f, t, r) ON o_orderpriority = b.p AND CAST(o_orderdate AS DATE) BETWEEN b.f AND coalesce(b.t, DATE '9999-12-31')",
    "j14_overlapping_orders": """
WITH i AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS placed, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) + CAST(floor(o_totalprice / 2000) AS INTEGER) END AS until FROM orders)
SELECT b.o_custkey, b.placed, count(*) AS n, bool_or(EXISTS (SELECT 1 FROM i a WHERE a.o_custkey = b.o_custkey AND a.placed < b.placed AND b.placed <= coalesce(a.until, DATE '9999-12-31'))) AS overlapped FROM i b GROUP BY 1, 2""",
    "j08_as_of_purchase": "SELECT c.event_id, b.value AS last_value FROM (SELECT * FROM events WHERE event_type = 'click') c ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'purchase' GROUP BY user_id, ts) b ON c.user_id = b.user_id AND c.ts >= b.ts",
    "w10_first_recovery": "SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nth FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) WHERE event_type = 'purchase' AND before = 'error') WHERE nth = 1",
    "w12_event_index": "SELECT event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) - 1 AS attempt_index FROM events",
    "w17_running_purchase": "SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS current_bought FROM events",
    "i01_forbidden_keys": "SELECT event_type, CASE WHEN event_id % 7 = 0 THEN 'token' ELSE '' END AS names, count(*) AS n FROM events GROUP BY 1, 2",
    "f44_salted_hash": "SELECT c_custkey, sha256(concat('pepper', lower(trim(concat(' ', c_name, '@X.org'))))) AS mail_hash FROM customer",
    "a28_nearest_rank_value": "SELECT o_orderstatus, list_sort(list(o_totalprice))[CAST(round_even(0.85 * (count(*) - 1), 0) AS BIGINT) + 1] AS p85 FROM orders GROUP BY o_orderstatus",
    "f30_issue_keys": "SELECT concat('IML-', o_custkey % 50) AS issue_key, count(*) AS n FROM orders GROUP BY 1",
    "d03_path_kinds": "SELECT CASE o_orderkey % 11 WHEN 0 THEN 'feature' WHEN 1 THEN 'step_definition' WHEN 2 THEN 'spec' WHEN 3 THEN 'spec' WHEN 4 THEN 'page_object' WHEN 5 THEN 'fixture' WHEN 8 THEN 'spec' WHEN 9 THEN 'fixture' END AS kind, count(*) AS n FROM orders GROUP BY 1",
    "d06_decline_reason": "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'declined_by_author' WHEN o_orderkey % 7 = 1 THEN 'changes_requested_unresolved' WHEN o_orderkey % 4 = 2 THEN 'unknown' ELSE 'declined_by_reviewer' END AS reason FROM orders WHERE o_orderstatus = 'P'",
    "d10_attributed_issues": """
WITH l AS (
  SELECT l_orderkey, l_linenumber, l_partkey, list_extract(['Relates to', 'tests', 'clones', 'blocks', 'duplicates'], CAST(l_partkey % 5 AS INT) + 1) AS kind, concat(CASE WHEN l_partkey % 2 = 0 THEN 'A-' ELSE 'C-' END, l_partkey) AS target,
         list_extract([10, 1, 99, 5, 11], CAST(l_partkey % 5 AS INT) + 1) AS place FROM lineitem WHERE l_quantity < 9
), best AS (
  SELECT *, CASE WHEN place = 99 THEN 2 WHEN l_partkey % 2 = 1 THEN 0 ELSE 1 END AS level FROM l
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY level, CASE WHEN place = 99 THEN 0 ELSE place END, l_linenumber, target, kind) = 1
), x AS (
  SELECT concat('A-', o_orderkey) AS issue_key, CASE o_custkey % 3 WHEN 1 THEN concat('A-', o_custkey) WHEN 2 THEN concat('B-', o_custkey) END AS parent, o_custkey % 3 = 2 AS away, b.level, b.target, b.kind
  FROM orders LEFT JOIN best b ON o_orderkey = b.l_orderkey
)
SELECT issue_key, CASE WHEN p THEN parent ELSE target END AS target_key, CASE WHEN p THEN 'parent' ELSE 'issue_link:' || kind END AS source,
  CASE WHEN p AND away THEN CASE WHEN level = 0 THEN 0.7 ELSE 0.6 END WHEN p THEN 0.5 WHEN level = 0 THEN 0.7 WHEN level = 1 THEN 0.4 WHEN level = 2 THEN 0.2 ELSE 0.0 END::DOUBLE AS confidence
FROM (SELECT *, parent IS NOT NULL AND (away OR level IS NULL OR level = 2) AS p FROM x)""",
    "d12_test_runs": "SELECT c AS status_category, count(*) AS n, sum(CASE WHEN c <> 'not_run' THEN 1 ELSE 0 END)::BIGINT AS timed FROM (SELECT CASE o_orderkey % 8 WHEN 0 THEN 'passed' WHEN 1 THEN 'failed' WHEN 2 THEN 'skipped' WHEN 3 THEN 'in_progress' WHEN 4 THEN 'not_run' WHEN 5 THEN 'other' WHEN 6 THEN 'not_run' ELSE 'blocked' END AS c FROM orders) GROUP BY c",
    "f39_gates_and_errors": "SELECT list_extract(['test', 'lint', 'build', 'secrets', NULL, 'test'], CAST(event_id % 6 AS INT) + 1) AS gate, list_extract(['permission_denied', 'not_found', 'ambiguous_match', 'invalid_input', 'timeout', 'other', NULL], CAST(event_id % 7 AS INT) + 1) AS error, list_extract([0, NULL, -2], CAST(event_id % 3 AS INT) + 1) AS code, count(*) AS n FROM events GROUP BY 1, 2, 3",
    "f40_tool_kinds": "SELECT CASE WHEN user_id % 4 = 0 THEN 'mcp' ELSE list_extract(['terminal', 'file', 'file', 'http', 'other', 'other'], CAST(event_id % 6 AS INT) + 1) END AS kind, count(*) AS n FROM events GROUP BY 1",
    "f42_build_names": "SELECT CASE o_orderkey % 3 WHEN 0 THEN concat('Build', o_custkey % 5) WHEN 1 THEN 'plain job' END AS job, CASE WHEN o_orderkey % 3 = 0 THEN concat('release/', o_custkey % 3) END AS branch, count(*) AS n, count(CASE WHEN o_orderkey % 3 = 0 THEN 1 END) AS numbered FROM orders GROUP BY 1, 2",
    "i09_extra_attributes": "SELECT event_type, extra, count(*) AS n FROM (SELECT event_type, CASE WHEN event_id % 3 = 0 THEN CASE event_type WHEN 'view' THEN 'aa,zz' WHEN 'click' THEN 'aa' ELSE 'aa,k,zz' END WHEN event_type IN ('view', 'click') THEN '' ELSE 'k' END AS extra FROM events) WHERE extra <> '' GROUP BY 1, 2",
    "i11_clamped_times": "SELECT event_id, CASE WHEN late THEN NULL ELSE ts END AS ended_at, CASE WHEN event_id % 7 >= 2 THEN event_id % 7 - 2 END AS duration_ms, concat_ws(',', CASE WHEN late THEN 'DQ-10:ended_at' END, CASE WHEN event_id % 7 < 2 THEN 'DQ-10:duration_ms' END) AS flags FROM (SELECT *, ts > TIMESTAMP '2024-01-20 00:05:00' AS late FROM events)",
    "i15_relative_paths": "SELECT CASE WHEN event_id % 5 < 2 THEN 'f.ts' WHEN event_id % 5 = 2 THEN 'src/f.ts' END AS path, count(*) AS n FROM events GROUP BY 1",
    "i17_sheet_faults": "SELECT concat_ws('; ', CASE WHEN o_orderkey % 5 = 0 THEN 'name: missing' END, CASE o_orderkey % 5 WHEN 1 THEN 'hours: out of range' WHEN 2 THEN 'hours: out of range' WHEN 3 THEN 'hours: no number' END, CASE WHEN o_orderkey % 3 > 0 THEN 'day: no date' END) AS faults, count(*) AS n FROM orders GROUP BY 1",
    "k11_bundles": "SELECT strftime(ts, '%G-W%V') AS iso_week, count(*) AS n, count(*) AS lines FROM events GROUP BY 1",
}
