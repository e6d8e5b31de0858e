"""Events of commits, reports against trails, identities and session usage on rows made of the stored tables; each with SQL of its own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deliverylens.functions import columns as C

from . import commits, identities, reconcile, tracker, usage
from .state_queries import _SAME_E, _events, _t


# ---- commits: orders are commits, their lines the files


def _commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open orders are marked, urgent ones name a run (twice, the last counts), low ones have no message. Lines of over 40 are binary."""
    li = _t(spark, sf_dir, "lineitem")
    n = F.col("l_linenumber")
    path = F.concat(F.element_at(F.array(*[F.lit(x) for x in ("src/f", "tests/t", "docs/d", "cfg/c")]), n % 4 + 1), F.col("l_partkey"), F.element_at(F.array(*[F.lit(x) for x in (".py", ".py", ".md", ".yaml")]), n % 4 + 1))
    path = F.when(F.col("l_quantity") == 3, F.concat(F.lit("/home/me/"), path)).when(F.col("l_quantity") == 4, F.concat(F.repeat(F.lit("d/"), 100), path)).otherwise(path)
    line = F.when(F.col("l_quantity") > 40, "-\t-\timg.png").otherwise(F.concat(F.col("l_quantity").cast("int"), F.lit("\t"), n, F.lit("\t"), path))
    stats = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.concat(F.lit("\n"), F.array_join(F.collect_list(line), "\n")).alias("stats"))
    o = _t(spark, sf_dir, "orders").join(stats, "o_orderkey", "left")
    k = F.col("o_orderkey").cast("string")
    subject = F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("IML-"), F.col("o_custkey") % 40, F.lit(": AI change"))).otherwise("AIR change")
    trailers = F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("\n\ntext\nAI-Run-Id: old\nai-run-id:  run_"), k, F.lit(" \nAI-Trace-Id: t"), k, F.lit("\n"))).otherwise("\n\nAI-Run-Id:\n")
    return o.select(
        F.concat(F.lit("r"), F.col("o_custkey") % 3).alias("repo"), F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("fix/IML-"), F.col("o_custkey") % 50)).otherwise("main").alias("branch"), F.substring(F.sha2(k, 256), 1, 40).alias("sha"),
        F.col("o_orderdate").cast("timestamp").alias("authored"), F.concat(F.lit(" P"), F.col("o_custkey") % 7, F.lit("@X.Example")).alias("email"), F.when(F.col("o_orderpriority") != "5-LOW", F.concat(subject, trailers)).alias("message"), "stats",
    )


def _made(spark: SparkSession, sf_dir: str) -> DataFrame:
    return commits.commit_events(_commits(spark, sf_dir), ["IML"], "salt")


def d16_commit_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of all commits, and of the files of those in which AI had a hand."""
    e = _made(spark, sf_dir)
    return e.select("event_id", "event_type", F.col("event_time").cast("timestamp_ntz").alias("event_time"), "trace_id", "run_id", F.col("actor.person_email_hash").alias("author_hash"), F.col("context.jira_issue_key").alias("issue"), F.col("context.jira_project_key").alias("project"), F.col("context.repo_full_name").alias("repo"), F.col("context.branch_name").alias("branch"), "attributes", F.col("link.method").alias("method"), F.col("link.confidence").alias("confidence"))


def f38_artifact_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as files of several folders, names and endings, by their type of artifact."""
    k = F.col("l_partkey")
    folder = F.element_at(F.array(*[F.lit(x) for x in ("", "src/", "Tests/", "specs/", "fixtures/", "contest/")]), (k % 6 + 1).cast("int"))
    name = F.element_at(F.array(*[F.lit(x) for x in ("main.go", "a.spec.ts", "Dockerfile", "b.CSV", "readme.md", "login_steps.py", "app-mock.ts", "pom.yaml", "login.specification.md", "test_a.py", "dockerfile.txt")]), (F.col("l_suppkey") % 11 + 1).cast("int"))
    return _t(spark, sf_dir, "lineitem").groupBy(C.first_match(F.concat(folder, name), C.ARTIFACT_TYPES, "code").alias("artifact_type")).agg(F.count("*").alias("n"))


def d18_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes, some with a broken link, version or type, by their first fault."""
    e = _made(spark, sf_dir)
    repo, main = F.col("context.repo_full_name"), F.col("context.branch_name") == "main"
    e = e.withColumn("link", F.when(repo == "r0", F.struct(F.lit("guess").alias("method"), F.col("link.confidence").alias("confidence"))).when(repo == "r1", F.struct(F.col("link.method").alias("method"), (F.col("link.confidence") * 0.9).alias("confidence"))).otherwise(F.col("link")))
    e = e.withColumn("schema_version", F.when((repo == "r2") & main, "2.0.0").otherwise(F.col("schema_version"))).withColumn("event_type", F.when((repo == "r0") & main, "scm.push").otherwise(F.col("event_type")))
    return e.groupBy("event_type", repo.alias("repo"), commits.envelope_fault(e).alias("fault")).agg(F.count("*").alias("n"))


def i18_content_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What may not leave, by name, and how many events may."""
    e = _made(spark, sf_dir)
    leaks = commits.content_leaks(e, {"output.generated": ["output_id", "artifact_type", "file_path", "lines_added", "lines_removed"], "scm.commit": ["commit_sha", "lines_added", "lines_removed"]})
    told = leaks.groupBy("event_type", "name", "problem").agg(F.count("*").alias("n"))
    return told.unionByName(commits.shippable(e, leaks).groupBy("event_type").agg(F.count("*").alias("n")).select("event_type", F.lit(None).cast("string").alias("name"), F.lit("shipped").alias("problem"), "n"))


# ---- reports and trails: orders are reported work, lines leave trails


def _reports(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    o, li = _t(spark, sf_dir, "orders"), _t(spark, sf_dir, "lineitem")
    day = F.when(F.col("o_orderpriority") == "5-LOW", "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    case = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("TC-"), F.col("o_custkey") % 97)).when(F.col("o_orderstatus") == "O", "")
    reports = o.select(F.concat(F.lit("IML-"), F.col("o_custkey") % 300).alias("issue_key"), case.alias("case_key"), day.alias("day"))
    issues = li.where("l_partkey % 400 < 250").select(F.concat(F.lit("IML-"), F.col("l_partkey") % 400).alias("key"), F.col("l_shipdate").alias("day"))
    return reports, issues, li.select(F.concat(F.lit("TC-"), "l_suppkey").alias("key"), F.col("l_shipdate").alias("day"))


def h23_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of issue and case that people report, corroborated where both trails agree within a day."""
    reports, issues, cases = _reports(spark, sf_dir)
    m = reconcile.mappings(reconcile.judged(reports, issues, cases))
    return m.select("issue_key", "case_key", "observations", "both_trails_agree", F.array_join("days", ",").alias("days"), "confidence")


def h23_trail_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of what is reported left a trail."""
    reports, issues, cases = _reports(spark, sf_dir)
    return reconcile.completeness(reconcile.judged(reports, issues, cases), issues)


# ---- identities: six customers are one person, written in six ways at three addresses


def h25_identity_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of several names, names of several addresses, and names within two edits that share none."""
    g, v = F.floor(F.col("c_custkey") / 6), F.col("c_custkey") % 6
    b = F.substring(F.sha2(g.cast("string"), 256), 1, 12)
    name = F.when(v == 0, b).when(v == 1, F.concat(F.upper(b), F.lit(" ."))).when(v == 2, F.substring(b, 1, 11)).when(v == 3, F.concat(b, F.lit("xy"))).when(v == 4, F.concat(b, F.lit("-"), b)).otherwise(F.concat(F.lit("z"), b, F.substring(b, 2, 11)))
    return identities.collisions(_t(spark, sf_dir, "customer").select(name.alias("name"), F.concat(F.lit("M"), g * 3 + v % 3, F.lit("@x.y ")).alias("email")))


# ---- usage: purchases are model calls, clicks phases that ended, sign-ups runs


def _usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    k = F.col("k")
    call = F.to_json(F.struct(
        F.concat(F.lit("m_"), k % 5).alias("model_id"), F.when(k % 7 > 0, (k * 10).cast("string")).otherwise("n/a").alias("input_tokens"), F.when(k % 3 > 0, k).alias("output_tokens"), F.when(k % 4 == 0, k * 2).alias("cached_input_tokens"),
        F.when(k % 2 == 0, F.lit(5)).alias("cache_write_tokens"), F.lit(3).alias("request_count"), F.concat(k % 3, F.lit(".33")).alias("premium_requests"), F.when(k > 20, k * 3).alias("tool_definitions_tokens"), F.when(k < 90, k + 1).alias("system_tokens"), F.when(k % 10 > 0, k % 13).alias("conversation_tokens"),
    ))
    phase = F.to_json(F.struct(F.when(k % 3 == 0, "ok").when(k % 3 == 1, "failed").when(k % 2 == 0, "skipped").alias("status")))
    kind = F.when(F.col("t") == "purchase", "model.call").when(F.col("t") == "click", "run.phase.completed").when(F.col("t") == "signup", "run.started").otherwise("human.turn")
    run = F.when((F.col("t") != "purchase") | (k % 4 == 1), F.concat(F.lit("run_"), "user_id", F.date_format("ts", "_dd")))
    return e.select("n", "k", "v", kind.alias("event_type"), F.col("ts").cast("timestamp").alias("event_time"), run.alias("run_id"), F.when(k < 95, F.concat(F.lit("s"), "user_id")).alias("trace_id"), F.when(F.col("t") == "purchase", call).when(F.col("t") == "click", phase).alias("attributes"))


def _book(spark: SparkSession) -> DataFrame:
    """Two periods of m_0; m_1 has no rate for cached tokens, m_2 none for output, m_3 none at all; m_4 is a placeholder."""
    return spark.sql("""SELECT * FROM VALUES ('m_0', DATE '2020-01-01', DATE '2024-01-20', 30L, 60L, 3L, false), ('m_0', DATE '2024-01-21', NULL, 40L, 80L, 4L, false), ('m_1', DATE '2020-01-01', NULL, 10L, 20L, NULL, false),
      ('m_2', DATE '2020-01-01', NULL, 10L, NULL, 1L, false), ('m_4', DATE '2024-01-18', NULL, 7L, 9L, 1L, true) AS b(model_id, effective_from, effective_to, p_in, p_out, p_cached, placeholder)""")


def _premium(df: DataFrame) -> DataFrame:
    return df.withColumn("premium_requests", F.col("premium_requests").cast("double"))


def x12_session_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls that name a session and no run, read from their attributes, from the cutover on."""
    calls = _premium(usage.session_calls(_usage(spark, sf_dir), "2024-01-16"))
    return calls.withColumn("shutdown_at", F.col("shutdown_at").cast("timestamp_ntz"))


def x13_session_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Those calls priced on the day of their shutdown, cached tokens at their own rate."""
    p = usage.priced(usage.session_calls(_usage(spark, sf_dir), "2024-01-16"), _book(spark))
    return p.select("session_id", F.col("shutdown_at").cast("timestamp_ntz").alias("shutdown_at"), "model_id", "total_tokens", "priceable", "cost_nano", "placeholder")


def x14_session_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage and cost by session; a call without a price leaves the cost unknown."""
    return _premium(usage.by_session(usage.priced(usage.session_calls(_usage(spark, sf_dir), "2024-01-16"), _book(spark))))


def x23_phase_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phases of each run that ended well or failed."""
    return usage.phases(_usage(spark, sf_dir))


def g06_context_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the context of calls is made of, by week, where all three parts are told."""
    return usage.context_composition(_usage(spark, sf_dir), C.iso_week(F.col("event_time")))


def _sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of a user's week and of a whole user; one in five ids is of the emitter's own kind. Only large purchases are usage."""
    u = _usage(spark, sf_dir).where("event_type != 'model.call' OR v > 100")
    ids = F.array(F.concat("trace_id", F.date_format("event_time", "_dd").substr(1, 2)), F.col("trace_id"))
    return u.withColumn("trace_id", F.explode(ids)).withColumn("trace_id", F.when(F.col("trace_id").rlike("^s[0-9]*7"), F.concat(F.lit("trc_"), "trace_id")).otherwise(F.col("trace_id")))


def dq_session_without_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions with runs and no usage that are quiet for a day."""
    return usage.session_findings(_sessions(spark, sf_dir), "2024-01-30 12:00:00").where("finding = 'no usage'")


def dq_session_late_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions whose first usage came after their runs had left the rebuilt window, in a look-back that is long enough to see it."""
    return usage.session_findings(_sessions(spark, sf_dir), "2024-01-30 12:00:00", look_back=45).where("finding = 'late usage'")


def a24_payload_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that came with several payloads; names in another order are no other payload."""
    e = _events(spark, sf_dir)
    k = F.col("k")
    one, other = F.format_string('{"k": %d, "t": "%s"}', "k", "t"), F.format_string('{"t":"%s","k":%d}', "t", "k")
    told = F.when(k % 4 == 0, F.array(one, other)).when(k % 10 == 3, F.array(one, F.format_string('{"k": %d, "t": "%s"}', k + 1, "t"), one)).otherwise(F.array(one))
    d = e.select("n", F.explode(told).alias("attributes"))
    return d.groupBy(F.col("n").alias("event_id")).agg(F.count("*").alias("deliveries"), F.count_distinct(C.canonical_json(F.col("attributes"))).alias("payloads")).where("deliveries > 1")


def f35_label_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels shaped like the marker that are none of the known ones, by how many requests bear them."""
    o = _t(spark, sf_dir, "orders")
    k = F.col("o_custkey") % 6
    labels = F.when(k == 0, F.array(F.lit("Copilot_Authored"), F.lit(" copilot-made "))).when(k == 1, F.array(F.lit("COPILOT-MADE"), F.lit("by copilot"), F.lit("BY COPILOT"))).when(k == 2, F.array(F.lit("XCOPILOT"), F.lit(""), F.lit(None).cast("string"))).when(k == 3, F.array(F.lit("copilot_planned")))
    found = C.drifted_labels(labels, ["COPILOT_AUTHORED"], r"(?<![A-Z0-9])COPILOT(?![A-Z0-9])")
    return o.select(F.explode(found).alias("label")).groupBy("label").agg(F.count("*").alias("n"))


# ---- tests: orders are cycles, their lines runs of cases


def _cycles(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Cycles that are updated, or only created, or without any time, or without a key; runs of all states."""
    p, at = F.substring("o_orderpriority", 1, 1), F.col("o_orderdate").cast("timestamp")
    cycles = _t(spark, sf_dir, "orders").select(F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("cycle_key"), F.when(p == "1", at + F.expr("INTERVAL 400 DAYS")).alias("updated_at"), F.when(p != "5", at).alias("created_at"), F.lit(None).cast("timestamp").alias("start_at"), F.when(p == "2", at + F.expr("INTERVAL 30 DAYS")).alias("end_at"))
    states = F.array(*[F.lit(x) for x in ("Passed", " FAIL ", "blocked", "N/A", "WIP", "Not Run", "odd", None, "pass", "")])
    runs = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("cycle_key"), F.col("l_partkey").alias("case_id"), F.element_at(states, (F.col("l_suppkey") % 10 + 1).cast("int")).alias("status"), F.col("l_shipdate").alias("executed_at"), F.lit(None).cast("array<string>").alias("defects"), F.concat(F.lit("p"), F.col("l_partkey") % 50).alias("person_id"))
    return cycles, runs


def d20_test_runs_in_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of cycles that may have been active since a day, without those that are only planned."""
    cycles, runs = _cycles(spark, sf_dir)
    return tracker.run_pass(cycles, runs, "2001-03-01").groupBy("cycle_key", "status_category").agg(F.count("*").alias("n"))


def h03_executed_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each person's runs by category, what was executed, and the share that passed."""
    cycles, runs = _cycles(spark, sf_dir)
    return tracker.test_totals(tracker.run_pass(cycles, runs, None, include_not_run=True), "person_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    d16_commit_events, f38_artifact_types, d18_envelopes, i18_content_leaks, h23_reconciliation, h23_trail_completeness, h25_identity_collisions, x12_session_calls, x13_session_prices, x14_session_sums, x23_phase_rollup, g06_context_composition,
    d20_test_runs_in_window, h03_executed_tests, dq_session_without_usage, dq_session_late_usage, a24_payload_collisions, f35_label_drift,
)}

_ID = lambda prefix, *parts: f"concat('{prefix}_', substr(sha256(concat_ws(chr(31), {', '.join(parts)})), 1, 32))"
_MADE_SQL = f"""
c AS (SELECT o_orderkey AS k, substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 40) AS sha, concat('r', o_custkey % 3) AS repo, o_orderdate AS tm, sha256(concat('salt', 'p', o_custkey % 7, '@x.example')) AS hash,
  CASE WHEN o_orderstatus = 'F' THEN concat('fix/IML-', o_custkey % 50) ELSE 'main' END AS branch, o_orderstatus = 'O' AND o_orderpriority <> '5-LOW' AS marked, CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey END AS run,
  CASE WHEN o_orderstatus = 'O' AND o_orderpriority <> '5-LOW' THEN concat('IML-', o_custkey % 40) WHEN o_orderstatus = 'F' THEN concat('IML-', o_custkey % 50) END AS issue FROM orders),
f AS (SELECT l_orderkey AS k, CAST(l_quantity AS BIGINT) AS added, l_linenumber AS removed, ['code', 'test', 'doc', 'config'][l_linenumber % 4 + 1] AS kind,
  concat(CASE l_quantity WHEN 3 THEN '/home/me/' WHEN 4 THEN repeat('d/', 100) ELSE '' END, ['src/f', 'tests/t', 'docs/d', 'cfg/c'][l_linenumber % 4 + 1], l_partkey, ['.py', '.py', '.md', '.yaml'][l_linenumber % 4 + 1]) AS path FROM lineitem WHERE l_quantity <= 40),
s AS (SELECT k, CAST(sum(added) AS BIGINT) AS a, CAST(sum(removed) AS BIGINT) AS r FROM f GROUP BY k),
e AS (SELECT 'scm.commit' AS ty, {_ID("evt", "'scm.commit'", "repo", "sha")} AS id, c.*, CAST(NULL AS VARCHAR) AS path, concat('{{"commit_sha":"', sha, '","lines_added":', coalesce(a, 0), ',"lines_removed":', coalesce(r, 0), ',"has_ai_marker":', marked, '}}') AS att FROM c LEFT JOIN s ON c.k = s.k
  UNION ALL SELECT 'output.generated', {_ID("evt", "'output.generated'", "repo", "sha", "path")}, c.*, path, concat('{{"output_id":"', {_ID("out", "sha", "path")}, '","artifact_type":"', kind, '","file_path":"', path, '","lines_added":', added, ',"lines_removed":', removed, '}}') FROM c JOIN f ON c.k = f.k WHERE marked OR run IS NOT NULL)"""
_REPORTS_SQL = """
r AS (SELECT concat('IML-', o_custkey % 300) AS i, CASE WHEN o_orderstatus = 'F' THEN concat('TC-', o_custkey % 97) END AS c, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS d, row_number() OVER () AS id FROM orders),
ti AS (SELECT DISTINCT concat('IML-', l_partkey % 400) AS key, CAST(l_shipdate AS DATE) AS d FROM lineitem WHERE l_partkey % 400 < 250),
tc AS (SELECT DISTINCT concat('TC-', l_suppkey) AS key, CAST(l_shipdate AS DATE) AS d FROM lineitem),
j AS (SELECT r.*, r.id IN (SELECT r.id FROM r JOIN ti ON r.i = ti.key AND abs(r.d - ti.d) <= 1) AS in_i, r.id IN (SELECT r.id FROM r JOIN tc ON r.c = tc.key AND abs(r.d - tc.d) <= 1) AS in_c FROM r)"""
_USAGE_SQL = f"""
{_SAME_E}, u AS (SELECT *, CASE WHEN k < 95 THEN concat('s', user_id) END AS session, CASE WHEN k % 7 > 0 THEN k * 10 END AS ti, CASE WHEN k % 3 > 0 THEN k END AS tout, CASE WHEN k % 4 = 0 THEN k * 2 END AS tc, CASE WHEN k % 2 = 0 THEN 5 END AS tw, concat('m_', k % 5) AS m FROM e),
b(model, since, till, p_in, p_out, p_c, ph) AS (VALUES ('m_0', DATE '2020-01-01', DATE '2024-01-20', 30, 60, 3, false), ('m_0', DATE '2024-01-21', DATE '9999-12-31', 40, 80, 4, false), ('m_1', DATE '2020-01-01', DATE '9999-12-31', 10, 20, NULL, false), ('m_2', DATE '2020-01-01', DATE '9999-12-31', 10, NULL, 1, false), ('m_4', DATE '2024-01-18', DATE '9999-12-31', 7, 9, 1, true)),
j AS (SELECT * FROM u WHERE t = 'purchase' AND k % 4 <> 1 AND session IS NOT NULL AND ts >= TIMESTAMP '2024-01-16'),
p AS (SELECT j.*, CASE WHEN ti IS NOT NULL OR tout IS NOT NULL THEN coalesce(ti, 0) + coalesce(tout, 0) END AS total, p_in IS NOT NULL AND p_out IS NOT NULL AND (coalesce(tc, 0) = 0 OR p_c IS NOT NULL) AS ok, coalesce(ph, false) AS ph,
  CASE WHEN coalesce(tc, 0) = 0 OR p_c IS NOT NULL THEN greatest(coalesce(ti, 0) - coalesce(tc, 0), 0) * p_in + coalesce(tout, 0) * p_out + coalesce(tc, 0) * coalesce(p_c, 0) END AS cost FROM j LEFT JOIN b ON m = model AND CAST(ts AS DATE) BETWEEN since AND till)"""
_SESSIONS_SQL = """
SELECT CASE WHEN regexp_matches(sid, '^s[0-9]*7') THEN concat('trc_', sid) ELSE sid END AS sid, t, ts FROM (SELECT unnest([concat(session, strftime(ts, '_%d')[1:2]), session]) AS sid, t, ts FROM u WHERE session IS NOT NULL AND (t <> 'purchase' OR v > 100) AND ts >= {since})"""
_SUM = lambda x, name: f"CAST(sum({x}) AS BIGINT) AS {name}"
ORACLE_SQL = {
    "d16_commit_events": f"""WITH {_MADE_SQL} SELECT id AS event_id, ty AS event_type, tm AS event_time, CASE WHEN ty = 'scm.commit' THEN 't' || run END AS trace_id, 'run_' || run AS run_id, CASE WHEN ty = 'scm.commit' THEN hash END AS author_hash, issue, CASE WHEN issue IS NOT NULL THEN 'IML' END AS project, repo, branch, att AS attributes,
  CASE WHEN run IS NOT NULL THEN 'explicit' WHEN ty = 'scm.commit' THEN 'marker_only' ELSE 'heuristic' END AS method, CASE WHEN run IS NOT NULL THEN 1.0 WHEN ty = 'scm.commit' THEN 0.3 ELSE 0.4 END::DOUBLE AS confidence FROM e""",
    "f38_artifact_types": """
SELECT CASE WHEN f = 2 OR n IN (1, 5, 9) THEN 'test' WHEN f = 3 AND n = 4 OR n = 8 THEN 'spec' WHEN f = 4 OR n = 6 THEN 'mock' WHEN n IN (2, 7) THEN 'config' WHEN n = 3 THEN 'csv' WHEN n = 4 THEN 'doc' ELSE 'code' END AS artifact_type, count(*) AS n
FROM (SELECT l_partkey % 6 AS f, l_suppkey % 11 AS n FROM lineitem) AS p GROUP BY 1""",
    "d18_envelopes": f"""WITH {_MADE_SQL} SELECT CASE WHEN repo = 'r0' AND branch = 'main' THEN 'scm.push' ELSE ty END AS event_type, repo, CASE WHEN repo = 'r0' AND branch = 'main' THEN 'event_type' WHEN repo = 'r2' AND branch = 'main' THEN 'schema_version' WHEN repo = 'r0' THEN 'link.method' WHEN repo = 'r1' AND run IS NOT NULL THEN 'link.confidence' END AS fault, count(*) AS n FROM e GROUP BY 1, 2, 3""",
    "i18_content_leaks": f"""WITH {_MADE_SQL}, x AS (SELECT *, CASE WHEN path LIKE '/home/%' THEN 'absolute path' WHEN length(path) > 200 THEN 'long value' END AS pr FROM e)
SELECT ty AS event_type, 'has_ai_marker' AS name, 'not allowed' AS problem, count(*) AS n FROM x WHERE ty = 'scm.commit' GROUP BY 1 UNION ALL SELECT ty, 'file_path', pr, count(*) FROM x WHERE pr IS NOT NULL GROUP BY 1, 3 UNION ALL SELECT ty, NULL, 'shipped', count(*) FROM x WHERE pr IS NULL AND ty <> 'scm.commit' GROUP BY 1""",
    "h23_reconciliation": f"WITH {_REPORTS_SQL} SELECT i AS issue_key, c AS case_key, count(*) AS observations, count(*) FILTER (in_i AND in_c) AS both_trails_agree, coalesce(string_agg(DISTINCT CAST(d AS VARCHAR), ',' ORDER BY CAST(d AS VARCHAR)), '') AS days, CASE WHEN count(*) FILTER (in_i AND in_c) > 0 THEN 'corroborated' ELSE 'reported_only' END AS confidence FROM j WHERE c IS NOT NULL GROUP BY 1, 2",
    "h23_trail_completeness": f"WITH {_REPORTS_SQL} SELECT count(*) AS n_rows, count(*) FILTER (in_i) AS rows_with_trail, count(*) FILTER (NOT coalesce(in_i, false)) AS rows_without_trail, round(100.0 * count(*) FILTER (in_i) / count(*), 1)::DOUBLE AS pct, count(DISTINCT i) AS issues_reported, count(DISTINCT CASE WHEN i IN (SELECT key FROM ti) THEN i END) AS issues_with_trail FROM j",
    "h25_identity_collisions": """
WITH b AS (SELECT c_custkey // 6 AS g, c_custkey % 6 AS v, substr(sha256(CAST(c_custkey // 6 AS VARCHAR)), 1, 12) AS b FROM customer),
w AS (SELECT concat('m', g * 3 + v % 3, '@x.y') AS email, [b, concat(upper(b), ' .'), b[1:11], concat(b, 'xy'), concat(b, '-', b), concat('z', b, b[2:12])][v + 1] AS name, [b, b, b[1:11], concat(b, 'xy'), concat(b, b), concat('z', b, b[2:12])][v + 1] AS norm FROM b),
d AS (SELECT norm, list(DISTINCT email) AS mails FROM w GROUP BY norm)
SELECT 'same address' AS kind, email AS entity, string_agg(DISTINCT name, ';' ORDER BY name) AS members, count(*) AS n FROM w GROUP BY email HAVING count(DISTINCT name) > 1
UNION ALL SELECT 'same name', norm, string_agg(DISTINCT email, ';' ORDER BY email), count(*) FROM w GROUP BY norm HAVING count(DISTINCT email) > 1
UNION ALL SELECT 'near names', x.norm, y.norm, levenshtein(x.norm, y.norm) FROM d x JOIN d y ON x.norm < y.norm AND abs(length(x.norm) - length(y.norm)) <= 2 WHERE levenshtein(x.norm, y.norm) <= 2 AND NOT list_has_any(x.mails, y.mails)""",
    "x12_session_calls": f"WITH {_USAGE_SQL} SELECT session AS session_id, ts AS shutdown_at, m AS model_id, ti AS input_tokens, tout AS output_tokens, tc AS cached_input_tokens, CAST(tw AS BIGINT) AS cache_write_tokens, CAST(NULL AS BIGINT) AS reasoning_tokens, CAST(3 AS BIGINT) AS request_count, CAST(NULL AS BIGINT) AS nano_aiu, k % 3 + 0.33::DOUBLE AS premium_requests FROM j",
    "x13_session_prices": f"WITH {_USAGE_SQL} SELECT session AS session_id, ts AS shutdown_at, m AS model_id, CAST(total AS BIGINT) AS total_tokens, ok AS priceable, CAST(cost AS BIGINT) AS cost_nano, ph AS placeholder FROM p",
    "x14_session_sums": f"""WITH {_USAGE_SQL} SELECT session AS session_id, count(*) AS model_calls, {_SUM("ti", "input_tokens")}, {_SUM("tout", "output_tokens")}, {_SUM("tc", "cached_input_tokens")}, {_SUM("tw", "cache_write_tokens")}, CAST(NULL AS BIGINT) AS reasoning_tokens, 3 * count(*) AS request_count, CAST(NULL AS BIGINT) AS nano_aiu, {_SUM("total", "total_tokens")},
  CAST(sum(k % 3 + 0.33) AS DOUBLE) AS premium_requests, CASE WHEN bool_and(ok) THEN CAST(sum(cost) AS BIGINT) END AS cost_nano, bool_or(ph) AS placeholder FROM p GROUP BY session""",
    "x23_phase_rollup": f"WITH {_SAME_E} SELECT concat('run_', user_id, strftime(ts, '_%d')) AS run_id, count(*) FILTER (k % 3 = 0) AS phases_ok, count(*) FILTER (k % 3 = 1) AS phases_failed FROM e WHERE t = 'click' GROUP BY 1",
    "g06_context_composition": f"""WITH {_SAME_E}, x AS (SELECT *, k > 20 AND k < 90 AND k % 10 > 0 AS w FROM e WHERE t = 'purchase')
SELECT strftime(ts, '%G-W%V') AS iso_week, count(*) FILTER (w) AS known, count(*) FILTER (NOT w) AS unknown, median(k * 3) FILTER (w) AS tool_definitions, median(k + 1) FILTER (w) AS system, median(k % 13) FILTER (w) AS conversation, median(k * 4 + 1 + k % 13) FILTER (w) AS total, min(k * 4 + 1 + k % 13) FILTER (w) AS least, max(k * 4 + 1 + k % 13) FILTER (w) AS most FROM x GROUP BY 1""",
    "d20_test_runs_in_window": """
WITH c AS (SELECT o_orderkey AS k FROM orders WHERE o_orderstatus <> 'P' AND (o_orderpriority = '5-LOW' OR o_orderdate + to_days(CASE o_orderpriority WHEN '1-URGENT' THEN 400 WHEN '2-HIGH' THEN 30 ELSE 0 END) >= TIMESTAMP '2001-03-01'))
SELECT l_orderkey AS cycle_key, ['passed', 'failed', 'blocked', 'skipped', 'in_progress', NULL, 'other', NULL, 'passed', NULL][l_suppkey % 10 + 1] AS status_category, count(*) AS n FROM lineitem JOIN c ON l_orderkey = k WHERE l_suppkey % 10 NOT IN (5, 7, 9) GROUP BY 1, 2""",
    "h03_executed_tests": """
SELECT concat('p', l_partkey % 50) AS person_id, count(*) FILTER (s IN (0, 8)) AS passed, count(*) FILTER (s = 1) AS failed, count(*) FILTER (s = 2) AS blocked, count(*) FILTER (s = 3) AS skipped, count(*) FILTER (s = 4) AS in_progress, count(*) FILTER (s IN (5, 7, 9)) AS not_run, count(*) FILTER (s = 6) AS other,
  count(*) FILTER (s IN (0, 1, 2, 3, 8)) AS executed, round(100.0::DOUBLE * count(*) FILTER (s IN (0, 8)) / nullif(count(*) FILTER (s IN (0, 1, 2, 3, 8)), 0), 1) AS pass_rate FROM (SELECT *, l_suppkey % 10 AS s FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P') GROUP BY 1""",
    "dq_session_without_usage": f"""WITH {_USAGE_SQL}, s AS ({_SESSIONS_SQL.format(since="TIMESTAMP '2024-01-16'")})
SELECT sid AS session_id, 'medium' AS severity, 'no usage' AS finding, count(*) FILTER (t = 'signup') AS amount FROM s WHERE NOT starts_with(sid, 'trc_') GROUP BY sid HAVING count(*) FILTER (t = 'signup') > 0 AND count(*) FILTER (t = 'purchase') = 0 AND max(ts) < TIMESTAMP '2024-01-29 12:00:00'""",
    "dq_session_late_usage": f"""WITH {_USAGE_SQL}, s AS ({_SESSIONS_SQL.format(since="TIMESTAMP '2023-12-16'")})
SELECT sid AS session_id, 'high' AS severity, 'late usage' AS finding, CAST((epoch_us(min(ts) FILTER (t = 'purchase')) - epoch_us(min(ts))) // 86400000000 AS BIGINT) AS amount FROM s WHERE NOT starts_with(sid, 'trc_') GROUP BY sid HAVING amount > 21""",
    "a24_payload_collisions": f"WITH {_SAME_E} SELECT n AS event_id, CASE WHEN k % 4 = 0 THEN 2 ELSE 3 END::BIGINT AS deliveries, CASE WHEN k % 4 = 0 THEN 1 ELSE 2 END::BIGINT AS payloads FROM e WHERE k % 4 = 0 OR k % 10 = 3",
    "f35_label_drift": """SELECT label, count(*) AS n FROM (SELECT unnest([['COPILOT-MADE'], ['BY COPILOT', 'COPILOT-MADE'], [], ['COPILOT_PLANNED']][o_custkey % 6 + 1]) AS label FROM orders WHERE o_custkey % 6 < 4) GROUP BY label""",
}
