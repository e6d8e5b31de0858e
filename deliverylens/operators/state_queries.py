"""Journals, chats, bindings and state kept between runs on files and rows made of the stored tables; each with SQL of its own."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deliverylens.functions import columns as C
from deliverylens.sources import inbox, polling
from deliverylens.sources.scratch import scratch
from deliverylens.streaming import sessions as session_stream

from . import binding, chat, sessions, snapshot, upkeep, watch
from .versions import Appended, VersionedTable


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored events: n, ts, user_id, t (their type), v, k."""
    return _t(spark, sf_dir, "events").select(F.col("event_id").alias("n"), F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", F.col("event_type").alias("t"), F.col("value").alias("v"), F.get_json_object("props", "$.k").cast("long").alias("k"))


# ---- journals: a user is a session, each stored event one or more of its records

_SAME_E = "e AS (SELECT event_id AS n, ts, user_id, event_type AS t, value AS v, CAST(props->>'$.k' AS BIGINT) AS k FROM events)"


def _journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(session_id, value): sign-ups start and resume, views are said, clicks are tool calls, purchases
    sub-agents (dear ones skills), errors shut down or abort."""
    e = _events(spark, sf_dir)
    k, n = F.col("k"), F.col("n").cast("string")

    def record(kind: Column | str, data: Column, suffix: str = "", after: int = 0) -> Column:
        at = F.date_format(F.col("ts") + F.make_dt_interval(secs=F.lit(after)), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        lit = F.lit(kind) if isinstance(kind, str) else kind
        return F.to_json(F.struct(F.format_string("r%08d%s", "n", F.lit(suffix)).alias("id"), lit.alias("type"), at.alias("timestamp"), F.try_parse_json(data).alias("data")))

    def data(**fields: Column) -> Column:
        return F.to_json(F.struct(*[c.alias(name) for name, c in fields.items()]))

    start = k < 50
    context = F.struct(F.when(start, "org/r").alias("repository"), F.concat(F.lit("b"), k % 3).alias("branch"), F.lit("c0").alias("baseCommit"), F.concat(F.lit("c"), k % 5 + 1).alias("headCommit"), F.when(start, "/w/r").alias("gitRoot"))
    command = F.struct(F.when(k < 40, "pytest -q").alias("command"), F.concat(F.lit("/w/r/f"), k, F.lit(".py")).alias("path"))
    tool = F.when(k < 40, "bash").when(k < 70, "edit").otherwise("view")
    done = F.struct(F.concat(F.lit("ran\n<exited with exit code "), k % 3, F.lit(">")).alias("content"))
    metrics = F.struct(F.struct(k.alias("linesAdded")).alias("metrics"))
    call, sub, below = F.concat(F.lit("c"), n), F.concat(F.lit("p"), n), F.concat(F.lit("q"), n)
    usage = F.struct(F.struct(F.struct(k.alias("inputTokens")).alias("usage")).alias("m"))
    made = (
        F.when(F.col("t") == "signup", F.array(record(F.when(start, "session.start").otherwise("session.resume"), data(context=context))))
        .when(F.col("t") == "view", F.array(record("user.message", data(content=F.repeat(F.lit("x"), k), source=F.when(k >= 90, "hook")))))
        .when(F.col("t") == "click", F.array(record("tool.execution_start", data(toolCallId=call, toolName=tool, arguments=command)), record("tool.execution_complete", data(toolCallId=call, success=k % 4 > 0, result=done, toolTelemetry=metrics), "b", 1)))
        .when((F.col("t") == "purchase") & (F.col("v") > 200), F.array(record("skill.invoked", data(name=F.concat(F.lit("s"), k % 2)))))
        .when(F.col("t") == "purchase", F.array(
            record("subagent.started", data(toolCallId=sub, agentName=F.concat(F.lit("a"), k % 3))),
            record("tool.execution_start", data(toolCallId=below, toolName=F.lit("grep"), parentToolCallId=sub), "b", 1),
            record("tool.execution_complete", data(toolCallId=below, success=F.lit(True)), "c", 2),
            record("subagent.completed", data(toolCallId=sub), "d", 3),
        ))
        .otherwise(F.array(record(F.when(k < 30, "session.shutdown").otherwise("abort"), data(totalApiDurationMs=k, modelMetrics=usage))))
    )
    return e.select(F.concat(F.lit("u"), "user_id").alias("session_id"), F.explode(made).alias("value"))


def _shown(events: DataFrame) -> DataFrame:
    at = F.col("event_time").cast("timestamp_ntz").alias("event_time")
    return events.select("event_id", "event_type", at, "trace_id", "run_id", "parent_run_id", "agent_name", "skill_name", "repo_full_name", "branch_name", "attributes")


def d14_session_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Journals written, read again with a torn line in each file, and made into events by windows."""
    out = scratch(spark, "journals")
    lines = _journal(spark, sf_dir)
    torn = lines.groupBy("session_id").agg(F.substring(F.min("value"), 1, 20).alias("value"))
    lines.unionByName(torn).write.json(out)
    rows = sessions.records(spark.read.schema("session_id string, value string").json(out)).drop("at")
    kept = scratch(spark, "records")
    rows.write.parquet(kept)
    rows = spark.read.parquet(kept)
    last = rows.agg(F.max("at_us")).first()[0] or 0
    return _shown(sessions.events(sessions.resolve(rows, F.lit(last - 3_600_000_000))))


def r09_stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same journals taken in as a stream, by the state machine and its timers."""
    src, out = scratch(spark, "journals"), scratch(spark, "facts")
    _journal(spark, sf_dir).write.json(src)
    session_stream.run_facts(spark.readStream.schema("session_id string, value string").json(src), "1 hour", out, scratch(spark, "state"))
    return _shown(session_stream.stored_events(spark.read.parquet(out)))


_JOURNAL_SQL = f"""
WITH {_SAME_E}, x AS (SELECT *, concat('u', user_id) AS s, printf('r%08d', n) AS r FROM e),
rec AS (
  SELECT s, ts AS tm, r AS rid, CASE WHEN k < 50 THEN 'start' ELSE 'resume' END AS kind, k, n FROM x WHERE t = 'signup'
  UNION ALL SELECT s, ts, r, CASE WHEN k < 90 THEN 'say' ELSE 'noise' END, k, n FROM x WHERE t = 'view'
  UNION ALL SELECT s, ts, r, 'noise', k, n FROM x WHERE t = 'click'
  UNION ALL SELECT s, ts + INTERVAL 1 SECOND, concat(r, 'b'), 'done', k, n FROM x WHERE t = 'click'
  UNION ALL SELECT s, ts, r, 'skill', k, n FROM x WHERE t = 'purchase' AND v > 200
  UNION ALL SELECT s, ts, r, 'sub', k, n FROM x WHERE t = 'purchase' AND NOT v > 200
  UNION ALL SELECT s, ts + INTERVAL 1 SECOND, concat(r, 'b'), 'noise', k, n FROM x WHERE t = 'purchase' AND NOT v > 200
  UNION ALL SELECT s, ts + INTERVAL 2 SECOND, concat(r, 'c'), 'below', k, n FROM x WHERE t = 'purchase' AND NOT v > 200
  UNION ALL SELECT s, ts + INTERVAL 3 SECOND, concat(r, 'd'), 'subend', k, n FROM x WHERE t = 'purchase' AND NOT v > 200
  UNION ALL SELECT s, ts, r, CASE WHEN k < 30 THEN 'shut' ELSE 'abort' END, k, n FROM x WHERE t = 'error'),
own AS (SELECT *, concat('run_', substr(sha256(concat(s, chr(31), rid)), 1, 32)) AS mine, concat('run_', substr(sha256(concat(s, chr(31), printf('r%08d', n))), 1, 32)) AS child, kind IN ('start', 'resume') AS opens,
  coalesce(tm - lag(tm) OVER w >= INTERVAL 24 HOUR, false) AS gap, lead(tm) OVER w AS nxt FROM rec WINDOW w AS (PARTITION BY s ORDER BY tm, rid)),
m AS (SELECT *, coalesce(nxt - tm >= INTERVAL 24 HOUR, false) AS cut, nxt IS NULL AND tm + INTERVAL 24 HOUR <= (SELECT max(tm) FROM rec) - INTERVAL 1 HOUR AS idle, CASE WHEN opens THEN mine WHEN kind = 'shut' OR gap THEN '' END AS mark, CASE WHEN opens THEN epoch_us(tm) WHEN kind = 'shut' OR gap THEN -1 END AS since FROM own),
h AS (SELECT *, last_value(mark IGNORE NULLS) OVER b AS was, last_value(since IGNORE NULLS) OVER b AS was_at,
  CASE WHEN min(CASE WHEN kind = 'skill' THEN k % 2 END) OVER u = max(CASE WHEN kind = 'skill' THEN k % 2 END) OVER u THEN concat('s', min(CASE WHEN kind = 'skill' THEN k % 2 END) OVER u) END AS skill,
  last_value(CASE WHEN kind = 'start' THEN 'org/r' END IGNORE NULLS) OVER u AS repo, last_value(CASE WHEN opens THEN concat('b', k % 3) END IGNORE NULLS) OVER u AS branch,
  count(*) FILTER (kind IN ('say', 'abort')) OVER u - 1 AS turn, count(*) FILTER (kind = 'done' AND k < 40) OVER u - 1 AS attempt FROM m
  WINDOW b AS (PARTITION BY s ORDER BY tm, rid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), u AS (PARTITION BY s ORDER BY tm, rid ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
g AS (SELECT *, CASE WHEN opens THEN mine WHEN gap THEN NULL ELSE nullif(was, '') END AS run FROM h),
closed AS (SELECT s, max((tm, rid)) AS stop, arg_max((tm, skill, repo), (tm, rid)) AS c FROM g WHERE kind = 'shut' OR cut OR idle GROUP BY s),
ranges AS (SELECT g.s, g.branch, arg_max(concat('c', k % 5 + 1), (g.tm, rid)) AS head, any_value(c) AS c FROM g JOIN closed ON g.s = closed.s AND (g.tm, g.rid) <= closed.stop WHERE opens GROUP BY 1, 2),
f AS (
  SELECT s, rid, CASE kind WHEN 'start' THEN 'run.started' WHEN 'resume' THEN 'run.started' ELSE 'run:subagent' END AS suffix, 'run.started' AS ty, tm, CASE kind WHEN 'sub' THEN child ELSE run END AS run, CASE kind WHEN 'sub' THEN run END AS parent, CASE kind WHEN 'sub' THEN concat('a', k % 3) ELSE 'copilot.cli' END AS agent, skill, repo, branch,
    concat('{{"input_source":"', CASE kind WHEN 'sub' THEN 'subagent' ELSE kind END, '","invocation_mode":"unknown"}}') AS att FROM g WHERE opens OR kind = 'sub'
  UNION ALL SELECT s, rid, 'run:subagent_end', 'run.completed', tm, child, run, concat('a', k % 3), skill, repo, branch, '{{}}' FROM g WHERE kind = 'subend'
  UNION ALL SELECT s, rid, 'tool.call', 'tool.call', tm, child, NULL, concat('a', k % 3), skill, repo, branch, '{{"status":"ok","tool_kind":"file","tool_name":"grep"}}' FROM g WHERE kind = 'below'
  UNION ALL SELECT s, rid, 'tool.call', 'tool.call', tm, run, NULL, 'copilot.cli', skill, repo, branch, concat('{{"status":"', CASE WHEN k % 4 > 0 THEN 'ok' ELSE 'error' END, CASE WHEN k < 40 THEN '","tool_kind":"terminal","tool_name":"bash"}}' WHEN k < 70 THEN '","tool_kind":"file","tool_name":"edit"}}' ELSE '","tool_kind":"file","tool_name":"view"}}' END) FROM g WHERE kind = 'done'
  UNION ALL SELECT s, rid, 'gate:test', 'gate.evaluated', tm, run, NULL, 'copilot.cli', skill, repo, branch, concat('{{"attempt_index":"', attempt, '","gate_name":"test","status":"', CASE WHEN k % 3 = 0 THEN 'pass' ELSE 'fail' END, '"}}') FROM g WHERE kind = 'done' AND k < 40
  UNION ALL SELECT s, rid, 'output', 'output.generated', tm, run, NULL, 'copilot.cli', skill, repo, branch, concat('{{"artifact_type":"code","file_path":"f', k, '.py","lines_added":"', k, '","output_id":"out_', substr(sha256(concat(s, chr(31), rid, chr(31), 'f', k, '.py')), 1, 32), '"}}') FROM g WHERE kind = 'done' AND k BETWEEN 40 AND 69 AND k % 4 > 0 AND repo IS NOT NULL
  UNION ALL SELECT s, rid, 'human.turn', 'human.turn', tm, run, NULL, 'copilot.cli', skill, repo, branch, CASE kind WHEN 'say' THEN concat('{{"chars":"', k, '","turn_index":"', turn, '"}}') ELSE concat('{{"turn_index":"', turn, '","turn_kind":"correction"}}') END FROM g WHERE kind IN ('say', 'abort')
  UNION ALL SELECT s, rid, 'run:end', 'run.completed', tm, run, NULL, 'copilot.cli', skill, repo, branch, concat('{{"duration_ms":"', CAST(floor((epoch_us(tm) - was_at) / 1000) AS BIGINT), '"}}') FROM g WHERE kind = 'shut' AND run IS NOT NULL
  UNION ALL SELECT s, rid, 'model:m', 'model.call', tm, NULL, NULL, 'copilot.cli', skill, repo, branch, concat('{{"input_tokens":"', k, '","latency_ms":"', k, '","model_id":"m"}}') FROM g WHERE kind = 'shut'
  UNION ALL SELECT s, run, 'run:abandoned', 'run.abandoned', tm + INTERVAL 24 HOUR, run, NULL, 'copilot.cli', skill, repo, branch, '{{"reason":"idle"}}' FROM g WHERE (cut OR idle) AND kind <> 'shut' AND run IS NOT NULL
  UNION ALL SELECT s, '', concat('run:bound:', branch), 'run.bound', c[1], NULL, NULL, 'copilot.cli', c[2], c[3], branch, concat('{{"base_commit_sha":"c0","copilot_session_id":"', s, '","head_commit_sha":"', head, '"}}') FROM ranges WHERE c[3] IS NOT NULL)
SELECT concat('evt_', substr(sha256(concat(s, chr(31), rid, chr(31), suffix)), 1, 32)) AS event_id, ty AS event_type, tm AS event_time, s AS trace_id, run AS run_id, parent AS parent_run_id, agent AS agent_name, skill AS skill_name, repo AS repo_full_name, branch AS branch_name, att AS attributes FROM f"""


# ---- chats: a conversation is a session, each user's turn a request


def d15_chat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat logs written as patches, replayed, and made into events."""
    t = _t(spark, sf_dir, "conversations").where("role IN ('user', 'assistant')")
    w = Window.partitionBy("conv_id").orderBy("turn")
    asked = F.col("role") == "user"
    t = t.withColumn("place", F.count_if(asked).over(w) - 1).where("place >= 0").withColumn("size", F.length("text"))
    js = lambda *c: F.to_json(F.struct(*c))
    text = F.concat(F.lit("look at IML-"), "size", F.lit(" please"))
    push = js(F.lit(2).alias("kind"), F.array(F.lit("requests")).alias("k"), F.array(F.struct(F.concat(F.lit("q"), "turn").alias("requestId"), F.lit("a/m-1-2").alias("modelId"), (F.lit(1_700_000_000_000) + F.col("turn") * 1000).alias("timestamp"), F.struct(text.alias("text")).alias("message"))).alias("v"))
    path = lambda *p: F.array(F.lit("requests"), F.col("place").cast("string"), *map(F.lit, p)).alias("k")
    result = js(F.lit(1).alias("kind"), path("result"), F.struct(F.struct(F.col("size").alias("promptTokens"), F.lit("old").alias("resolvedModel")).alias("metadata")).alias("v"))
    drop = js(F.lit(3).alias("kind"), path("result", "metadata", "resolvedModel"))
    tool = F.struct(F.array(F.struct(F.when(F.col("size") < 400, "read_file").otherwise("zap").alias("name"), F.struct(F.concat(F.lit("/x/IML-TC-"), F.col("size") % 7, F.lit(".ts")).alias("filePath")).alias("arguments"))).alias("toolCalls"))
    rounds = js(F.lit(2).alias("kind"), path("result", "metadata", "toolCallRounds"), F.array(tool).alias("v"))
    tokens = js(F.lit(1).alias("kind"), path("result", "metadata", "outputTokens"), F.col("size").alias("v"))
    lines = t.select(F.concat(F.lit("s"), "conv_id").alias("session_id"), "turn", F.posexplode(F.when(asked, F.array(push, result, drop)).otherwise(F.array(rounds, tokens))).alias("j", "value"))
    out = scratch(spark, "chats")
    lines.select("session_id", (F.col("turn") * 4 + F.col("j")).alias("line_no"), "value").write.json(out)
    requests = chat.replay(spark.read.schema("session_id string, line_no long, value string").json(out))
    branches = t.where(asked & (F.col("size") % 2 == 0)).select(F.concat(F.lit("s"), "conv_id").alias("session_id"), F.concat(F.lit("q"), "turn").alias("request_id"), F.lit("feat/IML-9").alias("branch"))
    e = chat.chat_events(requests, branches, ["IML"])
    return e.select("event_id", "event_type", F.col("event_time").cast("timestamp_ntz").alias("event_time"), "trace_id", "branch_name", "jira_issue_key", "test_case_key", "key_route", "link_confidence", "turn_index", "tool_name", "kind", "model_id", "input_tokens", "output_tokens")


_CHAT_SQL = """
WITH t AS (SELECT concat('s', conv_id) AS s, turn, role, length(text) AS size, count(*) FILTER (role = 'user') OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS place FROM conversations WHERE role IN ('user', 'assistant')),
q AS (SELECT *, size % 2 = 0 AS named, make_timestamp(1700000000000000 + turn * 1000000) AS tm FROM t WHERE role = 'user'),
a AS (SELECT s, place, arg_max(size, turn) AS said FROM t WHERE role = 'assistant' GROUP BY 1, 2),
tools AS (SELECT q.*, t.size % 7 AS tc, t.size AS tsize, row_number() OVER (PARTITION BY t.s, t.place ORDER BY t.turn) - 1 AS pos FROM t JOIN q USING (s, place) WHERE t.role = 'assistant'),
r AS (
  SELECT concat('turn:q', turn) AS suffix, 'human.turn' AS event_type, q.*, NULL::VARCHAR AS tc, CAST(place AS INT) AS turn_index, NULL::VARCHAR AS tool_name, 'prompt' AS kind, NULL::VARCHAR AS model_id, NULL::BIGINT AS input_tokens, NULL::BIGINT AS output_tokens FROM q
  UNION ALL SELECT concat('model:q', turn), 'model.call', q.*, NULL, NULL, NULL, NULL, 'm-1.2', size, said FROM q LEFT JOIN a USING (s, place)
  UNION ALL SELECT concat('tool:q', turn, ':', pos), 'tool.call', * EXCLUDE (tc, tsize, pos), concat('IML-TC-', tc), NULL, CASE WHEN tsize < 400 THEN 'read_file' ELSE 'zap' END, CASE WHEN tsize < 400 THEN 'read' ELSE 'other' END, NULL, NULL, NULL FROM tools)
SELECT concat('evt_', substr(sha256(concat(s, chr(31), suffix)), 1, 32)) AS event_id, event_type, tm AS event_time, s AS trace_id, CASE WHEN named THEN 'feat/IML-9' END AS branch_name,
  CASE WHEN named THEN 'IML-9' ELSE concat('IML-', size) END AS jira_issue_key, tc AS test_case_key, CASE WHEN tc IS NOT NULL THEN 'path' WHEN named THEN 'branch' ELSE 'prompt' END AS key_route, CASE WHEN tc IS NOT NULL THEN 0.7 WHEN named THEN 0.9 ELSE 0.5 END::DOUBLE AS link_confidence, turn_index, tool_name, kind, model_id, input_tokens, output_tokens FROM r"""


def d17_capture_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the keys of chat events were found, and how sure that is."""
    e = d15_chat_events(spark, sf_dir)
    return e.groupBy("event_type", "key_route", "link_confidence").agg(F.count("*").alias("n"), F.count_distinct("trace_id").alias("sessions"), F.count("jira_issue_key").alias("with_issue"), F.count("test_case_key").alias("with_case"))


# ---- bindings


def _runs(e: DataFrame) -> DataFrame:
    """Sign-ups of a user in a third of a day are one run; its end is its first error with k of 50 or more."""
    day = F.date_format("ts", "yyyyMMdd")
    e = e.withColumns({"session": F.concat_ws("_", F.lit("ses"), "user_id", day), "run_id": F.concat_ws("_", F.lit("run"), "user_id", day, F.floor(F.hour("ts") / 8).cast("string"))})
    g = e.groupBy("run_id", "session", "user_id").agg(F.min(F.when(F.col("t") == "signup", F.col("ts"))).alias("started_at"), F.min(F.when((F.col("t") == "error") & (F.col("k") >= 50), F.col("ts"))).alias("ended_at"))
    return g.where("started_at IS NOT NULL").withColumn("agent", F.concat(F.lit("agent_"), F.col("user_id") % 7))


def dq17c_shared_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of the last two days that several runs share in a day; stored sessions have three runs at most, so over one is told, not over twenty."""
    return binding.shared_sessions(_runs(_events(spark, sf_dir)), dt.datetime(2024, 1, 31), over=1)


_RUNS_SQL = f"""{_SAME_E},
r AS (SELECT concat_ws('_', 'run', user_id, strftime(ts, '%Y%m%d'), CAST(floor(hour(ts) / 8) AS INT)) AS run_id, concat_ws('_', 'ses', user_id, strftime(ts, '%Y%m%d')) AS session, user_id, min(ts) FILTER (t = 'signup') AS started_at, min(ts) FILTER (t = 'error' AND k >= 50) AS ended_at
  FROM e GROUP BY 1, 2, 3 HAVING count(*) FILTER (t = 'signup') > 0),
w AS (SELECT *, started_at - INTERVAL 5 MINUTE AS bind_from, coalesce(ended_at, started_at + INTERVAL 24 HOUR) + INTERVAL 5 MINUTE AS bind_to FROM r WHERE started_at < TIMESTAMP '2024-01-25')"""
#: The same with the windows of all runs.
ALL_RUNS_SQL = _RUNS_SQL.replace(" WHERE started_at < TIMESTAMP '2024-01-25'", "")


def x07_run_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All runs with the times that bind calls to them; the stored events all lie before the contract's cutover (2026-08-26)."""
    return binding.run_windows(_runs(_events(spark, sf_dir))).select("run_id", "session", "started_at", "bind_from", "bind_to")


def _spans(e: DataFrame) -> DataFrame:
    day = F.date_format("ts", "yyyyMMdd")
    return e.where("t = 'purchase'").select(F.concat(F.lit("evt_"), "n").alias("span_id"), F.concat_ws("_", F.lit("ses"), "user_id", day).alias("session"), F.col("ts").alias("start_time"))


def j05_span_binding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases are calls: each goes to one run of its session whose window holds it, the latest start wins."""
    e = _events(spark, sf_dir)
    return binding.bind_spans(_spans(e), binding.run_windows(_runs(e))).select("span_id", "run_id")


def j19_interval_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An hour of a user's purchases and views is a session; dear clicks name the run of their time explicitly."""
    e = _events(spark, sf_dir).withColumn("hour", F.date_format("ts", "yyyyMMddHH"))
    hour = F.concat_ws("_", F.lit("h"), "user_id", "hour")
    s = e.where("t IN ('purchase', 'view')").groupBy(hour.alias("session"), "user_id").agg(F.collect_set(F.concat(F.lit("agent_"), F.col("k") % 7)).alias("agents"), F.min("ts").alias("t0"), F.max("ts").alias("t1"))
    run = F.concat_ws("_", F.lit("run"), "user_id", F.date_format("ts", "yyyyMMdd"), F.floor(F.hour("ts") / 8).cast("string"))
    bound = e.where("t = 'click' AND v > 60").select(run.alias("run_id"), hour.alias("session")).distinct()
    return binding.link_sessions(s, _runs(e), bound, "user_id")


# ---- state between runs


def h22_silence_watch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs on the same table of state: users are people, their errors the uploads."""
    e = _events(spark, sf_dir)
    roster = e.select(F.concat(F.lit("U"), "user_id").alias("person")).distinct()
    table = VersionedTable(spark, scratch(spark, "watch"), watch.STATE)
    table.replace(roster.select(F.lower("person").alias("person"), F.lit(dt.date(2024, 1, 2)).alias("roster_since"), F.lit(None).cast("long").alias("alerted_streak")), 0)
    out = scratch(spark, "reports")
    for day in (dt.date(2024, 1, 18), dt.date(2024, 1, 19), dt.date(2024, 1, 23)):
        up = e.where((F.col("t") == "error") & (F.col("ts") < F.lit(day).cast("timestamp_ntz"))).select(F.concat(F.lit("u"), "user_id").alias("person"), F.col("ts").cast("timestamp").alias("uploaded_at"))
        watch.check(up, roster, table, day, offset="+00:00").withColumn("checked_on", F.lit(day)).write.mode("append").parquet(out)
    return spark.read.parquet(out)


_WATCH_SQL = f"""
WITH {_SAME_E}, runs AS (SELECT unnest([DATE '2024-01-18', DATE '2024-01-19', DATE '2024-01-23']) AS d),
work AS (SELECT d, d - CAST(b AS INT) AS day, row_number() OVER (PARTITION BY d ORDER BY b) AS nth FROM runs, range(1, 401) AS x(b) WHERE isodow(d - CAST(b AS INT)) < 6),
p AS (SELECT DISTINCT user_id FROM e),
up AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM e WHERE t = 'error'),
s AS (SELECT d, p.user_id, (SELECT max(day) FROM up WHERE up.user_id = p.user_id AND day < d) AS last_reported, least((SELECT min(day) FROM up WHERE up.user_id = p.user_id AND day < d), DATE '2024-01-02') AS began,
  (SELECT count(*) FROM work w WHERE w.d = runs.d AND nth <= 10 AND NOT EXISTS (SELECT 1 FROM up JOIN work v ON v.d = runs.d AND v.day = up.day AND v.nth <= w.nth WHERE up.user_id = p.user_id)) AS missed FROM runs, p),
a AS (SELECT *, missed >= 3 AND (SELECT count(*) FROM work w WHERE w.d = s.d AND w.day >= began) >= 3 AS due FROM s),
one AS (SELECT *, due AS alerting, CASE WHEN due THEN missed WHEN missed = 0 THEN NULL END AS told FROM a WHERE d = DATE '2024-01-18'),
two AS (SELECT a.*, a.due AND a.missed > coalesce(one.told, 0) AS alerting, CASE WHEN a.due AND a.missed > coalesce(one.told, 0) THEN a.missed WHEN a.missed = 0 THEN NULL ELSE one.told END AS told FROM a JOIN one USING (user_id) WHERE a.d = DATE '2024-01-19'),
three AS (SELECT a.*, a.due AND a.missed > coalesce(two.told, 0) AS alerting FROM a JOIN two USING (user_id) WHERE a.d = DATE '2024-01-23')
SELECT concat('u', user_id) AS person, missed, last_reported, (SELECT count(*) FROM work w WHERE w.d = z.d AND w.day >= began) >= 3 AS settled, alerting, d AS checked_on
FROM (SELECT d, user_id, missed, last_reported, began, alerting FROM one UNION ALL SELECT d, user_id, missed, last_reported, began, alerting FROM two UNION ALL SELECT d, user_id, missed, last_reported, began, alerting FROM three) AS z"""


def r03_high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events polled by type in three passes: one whole, one that fails half way, one partial; rows and marks after them."""
    e = _events(spark, sf_dir).select(F.concat(F.lit("evt_"), "n").alias("event_id"), "t", F.col("ts").cast("timestamp").alias("updated_at"), "k")
    e = e.withColumn("k", F.coalesce("k", F.lit(0)))
    rows = Appended(spark, scratch(spark, "polled"), "event_id string, t string, updated_at timestamp")
    marks = VersionedTable(spark, scratch(spark, "marks"), polling.MARKS)

    def source(t: str, until: str, broken: bool = False) -> Callable[[object], DataFrame]:
        def read(since: object) -> DataFrame:
            out = e.where((F.col("t") == t) & (F.col("updated_at") < F.lit(until)))
            out = out if since is None else out.where(F.col("updated_at") >= F.lit(since))
            return out.where(F.when(F.col("k") >= 0, F.raise_error(F.lit("source went away")).isNull()) if broken else F.lit(True))

        return read

    for t in ("click", "view", "error"):
        polling.poll(source(t, "2024-01-10"), t, rows, marks)
    try:
        polling.poll(source("click", "2024-01-20", broken=True), "click", rows, marks)
    except Exception as error:
        if "source went away" not in str(error):
            raise
    polling.poll(source("view", "2024-01-20"), "view", rows, marks, complete=False)
    polling.poll(source("error", "2024-01-20"), "error", rows, marks)
    held = rows.read().groupBy(F.col("t").alias("source")).agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("ids"))
    return held.join(marks.read(), "source").select("source", "n", "ids", F.col("mark").cast("timestamp_ntz").alias("mark"), "runs")


_MARK_SQL = """
SELECT event_type AS source, count(*) FILTER (ts < CASE event_type WHEN 'click' THEN TIMESTAMP '2024-01-10' ELSE TIMESTAMP '2024-01-20' END) AS n, count(DISTINCT event_id) FILTER (ts < CASE event_type WHEN 'click' THEN TIMESTAMP '2024-01-10' ELSE TIMESTAMP '2024-01-20' END) AS ids,
  max(ts) FILTER (ts < CASE event_type WHEN 'error' THEN TIMESTAMP '2024-01-20' ELSE TIMESTAMP '2024-01-10' END) AS mark, CASE event_type WHEN 'error' THEN 2 ELSE 1 END::BIGINT AS runs
FROM events WHERE event_type IN ('click', 'view', 'error') GROUP BY event_type"""


def _bundles(e: DataFrame, day: Column) -> DataFrame:
    """(user_id, day, events, value): a bundle a user and day, with the manifest that goes with it."""
    kind = F.when(F.col("t") == "view", "tool.call").when(F.col("t") == "click", "human.turn").otherwise("gate.evaluated")
    attribute = F.when(F.col("v") > 120, "path").otherwise("status")
    line = F.concat(F.lit('{"event_id":"evt_'), "n", F.lit('","event_type":"'), kind, F.lit('","event_time":"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), F.lit('","actor":{},"attributes":{"'), attribute, F.lit('":"'), "k", F.lit('"}}'))
    g = e.groupBy("user_id", day.alias("day")).agg(F.count("*").alias("events"), F.concat(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", line.alias("l")))), lambda x: x["l"]), "\n"), F.lit("\n")).alias("body"))
    head = F.struct(F.lit("telemetry-bundle").alias("format"), F.lit("1.2.0").alias("schema_version"), F.concat(F.lit("m"), "user_id").alias("machine_id"), F.concat("day", F.lit("T00:00:00Z")).alias("window_start"), F.concat("day", F.lit("T23:59:59Z")).alias("window_end"), (F.col("events") + F.when(F.col("events") > 4, 1).otherwise(0)).alias("event_count"), F.sha2("body", 256).alias("sha256"))
    return g.select("user_id", "day", "events", F.concat(F.to_json(F.struct(head.alias("_manifest"))), F.lit("\n"), F.rtrim("body", F.lit("\n"))).alias("value"))


def s10_inbox_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bundles written into an inbox (a user and week each) and imported twice: the ledger, and what the table holds by machine."""
    e = _events(spark, sf_dir)
    b = _bundles(e, F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd"))
    box = scratch(spark, "inbox")
    inbox.put_bundles(b.select(F.concat(F.concat_ws("_", "user_id", "day"), F.lit(".ndjson")).alias("name"), F.concat("value", F.lit("\n")).alias("value")), box)
    rows = Appended(spark, scratch(spark, "imported"), "event_id string, event_type string, person_id string")
    ledger = VersionedTable(spark, scratch(spark, "ledger"), inbox.LEDGER)
    allowed = {t: ["status"] for t in ("tool.call", "human.turn", "gate.evaluated")}
    none = spark.createDataFrame([], "file string, person_id string")
    inbox.import_inbox(box, rows, ledger, allowed, none)
    inbox.import_inbox(box, rows, ledger, allowed, none)
    held = rows.read().select("event_id").join(e.select(F.concat(F.lit("evt_"), "n").alias("event_id"), F.concat(F.lit("m"), "user_id").alias("machine_id")), "event_id").groupBy("machine_id").agg(F.count("*").alias("held"))
    told = ledger.read().groupBy("machine_id").agg(F.count("*").alias("bundles"), F.count("fault").alias("faulty"), F.sum("events").alias("events"), F.sum("rejected").alias("rejected"))
    return told.join(held, "machine_id", "left")


_INBOX_SQL = f"""
WITH {_SAME_E}, b AS (SELECT user_id, date_trunc('week', ts) AS w, count(*) AS n, count(*) FILTER (v > 120) AS bad FROM e GROUP BY 1, 2)
SELECT concat('m', user_id) AS machine_id, count(*) AS bundles, count(*) FILTER (n > 4) AS faulty, coalesce(sum(n - bad) FILTER (n <= 4), 0)::BIGINT AS events, coalesce(sum(bad) FILTER (n <= 4), 0)::BIGINT AS rejected, CAST(nullif(coalesce(sum(n - bad) FILTER (n <= 4), 0), 0) AS BIGINT) AS held
FROM b GROUP BY user_id"""


def r14_bundle_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored bundles (a user and day each) indexed by refreshes of bounded work until none remains."""
    b = _bundles(_events(spark, sf_dir), F.date_format("ts", "yyyy-MM-dd"))
    out = scratch(spark, "store")
    b.select(F.concat_ws("/", "user_id", "day").alias("key"), F.concat(F.lit("u"), "user_id").alias("person"), F.col("day").cast("timestamp").alias("uploaded_at"), "value").write.parquet(out)
    objects = spark.read.parquet(out)
    index = Appended(spark, scratch(spark, "index"), inbox.INDEX)
    budget = objects.count() // 3 + 1
    while inbox.refresh_index(objects, index, budget, "+07:00"):
        pass
    return inbox.indexed_days(index)


_INDEX_SQL = """
SELECT concat('u', user_id) AS person, CAST(ts + INTERVAL 7 HOUR AS DATE) AS day, CASE event_type WHEN 'view' THEN 'tool.call' WHEN 'click' THEN 'human.turn' ELSE 'gate.evaluated' END AS event_type, count(*) AS n FROM events GROUP BY 1, 2, 3"""


def _mart(events: DataFrame) -> DataFrame:
    """By day: events, and the size of the sessions that have one on it."""
    size = events.groupBy("trace_id").agg(F.count("*").alias("size"))
    return events.join(size, "trace_id").groupBy("day").agg(F.count("*").alias("n"), F.sum("size").alias("reach"))


def r05_late_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart of all but late events (errors of the 10th) and its rebuild when these arrive: only touched days are written."""
    e = _events(spark, sf_dir).select(F.to_date("ts").alias("day"), F.concat_ws("_", "user_id", F.date_format(F.date_trunc("week", "ts"), "yyyyMMdd")).alias("trace_id"), "t")
    late = e.where("t = 'error' AND day = DATE '2024-01-10'")
    path = scratch(spark, "mart")
    _mart(e.where("NOT (t = 'error' AND day = DATE '2024-01-10')")).write.partitionBy("day").parquet(path)
    days = upkeep.rebuild_late(e, late, _mart, path)
    return spark.read.parquet(path).select("day", "n", "reach", F.lit(days).cast("long").alias("rebuilt"))


_LATE_SQL = """
WITH e AS (SELECT CAST(ts AS DATE) AS day, concat_ws('_', user_id, date_trunc('week', ts)) AS ses, event_type AS t FROM events), s AS (SELECT ses, count(*) AS size FROM e GROUP BY 1), l AS (SELECT * FROM e WHERE t = 'error' AND day = DATE '2024-01-10')
SELECT day, count(*) AS n, sum(size)::BIGINT AS reach, (SELECT count(DISTINCT day) FROM e WHERE ses IN (SELECT ses FROM l)) AS rebuilt FROM e JOIN s USING (ses) GROUP BY day"""


def r15_pruned_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A buffer of events by day after covered days are deleted: receipts leave out purchases of the 5th."""
    e = _events(spark, sf_dir).select("n", "t", F.to_date("ts").alias("day"))
    path = scratch(spark, "buffer")
    e.write.partitionBy("day").parquet(path)
    receipts = e.where("NOT (t = 'purchase' AND day = DATE '2024-01-05')").groupBy("day").agg(F.count("*").alias("n"))
    upkeep.prune(path, receipts, "2024-01-15")
    return spark.read.parquet(path).groupBy("day").agg(F.count("*").alias("n"))


def i14_kept_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the keep-list leaves of journal records, by type and path."""
    v = F.try_parse_json("value")
    rows = _journal(spark, sf_dir).select(F.try_variant_get(v, "$.type", "string").alias("kind"), F.try_variant_get(v, "$.data", "variant").alias("data"))
    return rows.select("kind", F.explode(sessions.kept(F.col("kind"), F.col("data"))).alias("path", "x")).groupBy("kind", "path").agg(F.count("*").alias("n"), F.count_distinct("x").alias("values"))


_KEPT_SQL = f"""
WITH {_SAME_E}, p AS (
  SELECT CASE WHEN k < 50 THEN 'session.start' ELSE 'session.resume' END AS kind, unnest(CASE WHEN k < 50 THEN [('context.branch', concat('b', k % 3)), ('context.baseCommit', 'c0'), ('context.headCommit', concat('c', k % 5 + 1)), ('context.repository', 'org/r'), ('context.gitRoot', '/w/r')] ELSE [('context.branch', concat('b', k % 3)), ('context.baseCommit', 'c0'), ('context.headCommit', concat('c', k % 5 + 1))] END) AS x FROM e WHERE t = 'signup'
  UNION ALL SELECT 'user.message', ('source', 'hook') FROM e WHERE t = 'view' AND k >= 90
  UNION ALL SELECT 'tool.execution_start', unnest([('toolCallId', concat('c', n)), ('toolName', CASE WHEN k < 40 THEN 'bash' WHEN k < 70 THEN 'edit' ELSE 'view' END)]) FROM e WHERE t = 'click'
  UNION ALL SELECT 'tool.execution_complete', unnest([('toolCallId', concat('c', n)), ('success', CAST(k % 4 > 0 AS VARCHAR)), ('toolTelemetry.metrics.linesAdded', CAST(k AS VARCHAR))]) FROM e WHERE t = 'click'
  UNION ALL SELECT 'skill.invoked', ('name', concat('s', k % 2)) FROM e WHERE t = 'purchase' AND v > 200
  UNION ALL SELECT 'subagent.started', unnest([('toolCallId', concat('p', n)), ('agentName', concat('a', k % 3))]) FROM e WHERE t = 'purchase' AND NOT v > 200
  UNION ALL SELECT 'tool.execution_start', unnest([('toolCallId', concat('q', n)), ('toolName', 'grep'), ('parentToolCallId', concat('p', n))]) FROM e WHERE t = 'purchase' AND NOT v > 200
  UNION ALL SELECT 'tool.execution_complete', unnest([('toolCallId', concat('q', n)), ('success', 'true')]) FROM e WHERE t = 'purchase' AND NOT v > 200
  UNION ALL SELECT 'subagent.completed', ('toolCallId', concat('p', n)) FROM e WHERE t = 'purchase' AND NOT v > 200
  UNION ALL SELECT 'session.shutdown', ('totalApiDurationMs', CAST(k AS VARCHAR)) FROM e WHERE t = 'error' AND k < 30)
SELECT kind, x[1] AS path, count(*) AS n, count(DISTINCT x[2]) AS "values" FROM p GROUP BY 1, 2"""


def _domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the report: views are tool calls, clicks turns, purchases model calls, errors gates."""
    e = _events(spark, sf_dir).where("t != 'signup'")
    kind = F.when(F.col("t") == "view", "tool.call").when(F.col("t") == "click", "human.turn").when(F.col("t") == "purchase", "model.call").otherwise("gate.evaluated")
    status = F.when(F.col("t") == "view", F.when(F.col("k") % 8 == 1, "error").when(F.col("k") % 8 > 1, "ok")).when(F.col("t") == "error", F.when(F.col("k") % 9 > 3, "pass").when(F.col("k") % 9 > 0, "fail"))
    return e.select(F.concat(F.lit("p_"), "user_id").alias("person_id"), F.concat_ws("_", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd")).alias("session"), F.col("ts").alias("at"), kind.alias("kind"), status.alias("status"), F.when(F.col("k") % 7 != 6, F.floor(F.col("v") * 100)).alias("tokens_in"))


_SECTIONS = "struct<activity struct<basis string, prompts long, sessions long, active_days long>, tools struct<basis string, tool_calls long, tool_errors long, tool_error_rate double>, models struct<basis string, model_calls long, tokens_in long>, gates struct<basis string, gates_passed long, gates_failed long>>"
_FLAT = ["s.activity.basis AS activity", "s.activity.prompts", "s.activity.sessions", "s.activity.active_days", "s.tools.basis AS tools", "s.tools.tool_calls", "s.tools.tool_errors", "s.tools.tool_error_rate", "s.models.basis AS models", "s.models.model_calls", "s.models.tokens_in", "s.gates.basis AS gates", "s.gates.gates_passed", "s.gates.gates_failed"]


def g18_weekly_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON document of each week, put in place as one version and parsed again."""
    table = VersionedTable(spark, scratch(spark, "weekly"), "iso_week string, payload string")
    table.replace(snapshot.weekly_payloads(_domain(spark, sf_dir)), 0)
    p = F.from_json("payload", f"iso_week string, people long, events long, sections {_SECTIONS}")
    return table.read().select(p.alias("p")).select("p.iso_week", "p.people", "p.events", F.col("p.sections").alias("s")).selectExpr("iso_week", "people", "events", *_FLAT)


def h14_person_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of people, put in place and parsed again: a row a person and week."""
    table = VersionedTable(spark, scratch(spark, "people"), "person_id string, payload string")
    table.replace(snapshot.person_snapshots(_domain(spark, sf_dir), "2024-01-01", "2024-02-05"), 0)
    p = F.from_json("payload", f"person_id string, trend string, weeks array<struct<wk date, whole boolean, sections {_SECTIONS}>>")
    rows = table.read().select(p.alias("p")).select("p.person_id", "p.trend", F.explode("p.weeks").alias("w"))
    return rows.select("person_id", "trend", "w.wk", "w.whole", F.col("w.sections").alias("s")).selectExpr("person_id", "trend", "wk", "whole", *_FLAT)


_DOMAIN_SQL = f"""{_SAME_E}, d AS (SELECT *, CASE WHEN t = 'view' THEN CASE WHEN k % 8 = 1 THEN 'error' WHEN k % 8 > 1 THEN 'ok' END WHEN t = 'error' THEN CASE WHEN k % 9 > 3 THEN 'pass' WHEN k % 9 > 0 THEN 'fail' END END AS st FROM e WHERE t <> 'signup')"""
_TOTALS_SQL = """count(*) AS events, count(*) FILTER (t = 'click') AS prompts, count(DISTINCT (user_id, CAST(ts AS DATE))) AS sessions, count(DISTINCT CAST(ts AS DATE)) AS active_days, count(*) FILTER (t = 'view') AS tool_calls, count(*) FILTER (t = 'view' AND st IS NOT NULL) AS known, count(*) FILTER (st = 'error') AS errors,
  count(*) FILTER (t = 'purchase') AS model_calls, CAST(sum(CASE WHEN t = 'purchase' AND k % 7 <> 6 THEN floor(v * 100) END) AS BIGINT) AS tokens_in, count(*) FILTER (t = 'error') AS gates, count(*) FILTER (st = 'pass') AS good, count(*) FILTER (st = 'fail') AS poor"""
_FLAT_SQL = """CASE WHEN events > 0 THEN 'measured' ELSE 'no_data' END AS activity, prompts, sessions, active_days, CASE WHEN tool_calls > 0 THEN 'measured' ELSE 'no_data' END AS tools, nullif(tool_calls, 0) AS tool_calls, CASE WHEN known > 0 THEN errors END AS tool_errors, CASE WHEN known >= 5 THEN round(100.0::DOUBLE * errors / known, 1) END AS tool_error_rate,
  CASE WHEN model_calls > 0 THEN 'measured' ELSE 'no_data' END AS models, nullif(model_calls, 0) AS model_calls, tokens_in, CASE WHEN gates > 0 THEN 'measured' ELSE 'no_data' END AS gates, CASE WHEN good + poor > 0 THEN good END AS gates_passed, CASE WHEN good + poor > 0 THEN poor END AS gates_failed"""


def k13_spilled_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events streamed to a sink that fails for its first batches: they are spilled, sent again, and none is lost or doubled."""
    src, spill, out = scratch(spark, "outgoing"), scratch(spark, "spill"), scratch(spark, "sent")
    e = _events(spark, sf_dir).select("n", "t")
    e.repartition(4, "n").write.parquet(src)
    down = [True, True]

    def send(rows: DataFrame) -> None:
        if down:
            down.pop()
            raise ConnectionError("the sink is away")
        rows.select(F.col("n").cast("long").alias("n"), "t").write.mode("append").parquet(out)

    stream = spark.readStream.schema("n long, t string").option("maxFilesPerTrigger", 1).parquet(src)
    stream.writeStream.foreachBatch(upkeep.deliver(send, spill)).option("checkpointLocation", scratch(spark, "state")).trigger(availableNow=True).start().awaitTermination()
    again = upkeep.resend(spark, send, spill)
    return spark.read.parquet(out).groupBy("t").agg(F.count("*").alias("n"), F.count_distinct("n").alias("ids"), F.lit(again).cast("long").alias("resent"))


def k14_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of each day by their names: e-mail shaped props never leave, and the last day is written twice."""
    e = _events(spark, sf_dir)
    found = e.where("t = 'error'").groupBy(F.to_date("ts").cast("string").alias("detected_date"), F.concat(F.lit("user:"), "user_id").alias("subject")).agg(F.count("*").alias("n"), F.max("v").alias("value"))
    found = found.select("detected_date", F.lit("DQ-2").alias("check"), "subject", F.when(F.col("n") > 2, "high").otherwise("info").alias("severity"), "n", "value")
    path = scratch(spark, "findings")
    upkeep.write_findings(found, path)
    upkeep.write_findings(found.where("detected_date = '2024-01-30'"), path)
    return spark.read.json(path).select(F.col("detected_date").cast("date").alias("detected_date"), "check", "subject", "severity", "n")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    d14_session_events, r09_stream_sessions, d15_chat_events, d17_capture_routes, dq17c_shared_sessions, x07_run_window, j05_span_binding, j19_interval_link, h22_silence_watch, r03_high_water_mark, s10_inbox_import, r14_bundle_index,
    r05_late_rebuild, r15_pruned_days, i14_kept_paths, g18_weekly_payload, h14_person_snapshot, k13_spilled_batches, k14_findings,
)}
ORACLE_SQL = {
    "d14_session_events": _JOURNAL_SQL,
    "r09_stream_sessions": _JOURNAL_SQL,
    "d15_chat_events": _CHAT_SQL,
    "d17_capture_routes": f"SELECT event_type, key_route, link_confidence, count(*) AS n, count(DISTINCT trace_id) AS sessions, count(jira_issue_key) AS with_issue, count(test_case_key) AS with_case FROM ({_CHAT_SQL}) AS x GROUP BY 1, 2, 3",
    "dq17c_shared_sessions": f"WITH {_RUNS_SQL} SELECT session, CAST(started_at AS DATE) AS day, count(*) AS runs FROM r WHERE started_at >= TIMESTAMP '2024-01-29' GROUP BY 1, 2 HAVING count(*) > 1",
    "x07_run_window": f"WITH {ALL_RUNS_SQL} SELECT run_id, session, started_at, bind_from, bind_to FROM w",
    "j05_span_binding": f"WITH {ALL_RUNS_SQL} SELECT concat('evt_', n) AS span_id, arg_max(run_id, started_at) AS run_id FROM e JOIN w ON concat_ws('_', 'ses', e.user_id, strftime(ts, '%Y%m%d')) = session AND ts BETWEEN bind_from AND bind_to WHERE t = 'purchase' GROUP BY n",
    "j19_interval_link": f"""
WITH {_RUNS_SQL}, s AS (SELECT concat_ws('_', 'h', user_id, strftime(ts, '%Y%m%d%H')) AS session, user_id, list(DISTINCT concat('agent_', k % 7)) AS agents, min(ts) AS t0, max(ts) AS t1 FROM e WHERE t IN ('purchase', 'view') GROUP BY 1, 2),
b AS (SELECT concat_ws('_', 'h', e.user_id, strftime(ts, '%Y%m%d%H')) AS session, min(run_id) AS run_id FROM e JOIN r ON run_id = concat_ws('_', 'run', e.user_id, strftime(ts, '%Y%m%d'), CAST(floor(hour(ts) / 8) AS INT)) WHERE t = 'click' AND v > 60 GROUP BY 1),
c AS (SELECT s.session, count(r.run_id) AS n, min(r.run_id) AS run_id, bool_or(list_contains(agents, concat('agent_', r.user_id % 7))) AS agrees FROM s LEFT JOIN r ON s.user_id = r.user_id AND t0 >= started_at - INTERVAL 90 SECOND AND t1 <= coalesce(ended_at + INTERVAL 90 SECOND, started_at + INTERVAL 1 HOUR) GROUP BY 1)
SELECT session, CASE WHEN b.run_id IS NOT NULL THEN b.run_id WHEN n = 1 THEN c.run_id END AS run_id, CASE WHEN b.run_id IS NOT NULL THEN 'explicit' WHEN n = 1 THEN 'heuristic' END AS method, CAST(CASE WHEN b.run_id IS NOT NULL THEN 1.0 WHEN n = 1 THEN CASE WHEN agrees THEN 0.8 ELSE 0.5 END END AS DOUBLE) AS confidence,
  CASE WHEN b.run_id IS NOT NULL OR n = 1 THEN 'linked' WHEN n = 0 THEN 'no_run' ELSE 'several_runs' END AS outcome FROM c LEFT JOIN b USING (session)""",
    "h22_silence_watch": _WATCH_SQL,
    "r03_high_water_mark": _MARK_SQL,
    "s10_inbox_import": _INBOX_SQL,
    "r14_bundle_index": _INDEX_SQL,
    "r05_late_rebuild": _LATE_SQL,
    "r15_pruned_days": "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1 HAVING CAST(ts AS DATE) >= DATE '2024-01-15' OR (CAST(ts AS DATE) = DATE '2024-01-05' AND count(*) FILTER (event_type = 'purchase') > 0)",
    "i14_kept_paths": _KEPT_SQL,
    "g18_weekly_payload": f"WITH {_DOMAIN_SQL}, g AS (SELECT strftime(ts, '%G-W%V') AS iso_week, count(DISTINCT user_id) AS people, {_TOTALS_SQL} FROM d GROUP BY 1) SELECT iso_week, people, events, {_FLAT_SQL} FROM g",
    "h14_person_snapshot": f"""
WITH {_DOMAIN_SQL}, g AS (SELECT user_id, CAST(date_trunc('week', ts) AS DATE) AS wk, {_TOTALS_SQL} FROM d GROUP BY 1, 2),
s AS (SELECT user_id, wk, wk + 6 <= (SELECT CAST(max(ts) AS DATE) FROM d) AS whole FROM (SELECT DISTINCT user_id FROM d), (SELECT unnest([DATE '2024-01-01', DATE '2024-01-08', DATE '2024-01-15', DATE '2024-01-22', DATE '2024-01-29', DATE '2024-02-05']) AS wk)),
p AS (SELECT user_id, prompts - lag(prompts) OVER (PARTITION BY user_id ORDER BY wk) AS step FROM g JOIN s USING (user_id, wk) WHERE whole),
w AS (SELECT user_id, CASE WHEN count(*) < 2 THEN '-' WHEN count(*) FILTER (step > 0) > 0 AND count(*) FILTER (step < 0) > 0 THEN 'no clear trend' WHEN count(*) FILTER (step <> 0) = 0 THEN 'flat' ELSE concat(CASE WHEN count(*) FILTER (step > 0) > 0 THEN 'up' ELSE 'down' END, CASE WHEN count(*) > 2 THEN ' every week' ELSE '' END) END AS word FROM p GROUP BY 1)
SELECT concat('p_', user_id) AS person_id, coalesce(word, '-') AS trend, wk, whole, {_FLAT_SQL} FROM s LEFT JOIN g USING (user_id, wk) LEFT JOIN w USING (user_id)""",
    "k13_spilled_batches": "SELECT event_type AS t, count(*) AS n, count(DISTINCT event_id) AS ids, 2::BIGINT AS resent FROM events GROUP BY 1",
    "k14_findings": "SELECT CAST(ts AS DATE) AS detected_date, 'DQ-2' AS \"check\", concat('user:', user_id) AS subject, CASE WHEN count(*) > 2 THEN 'high' ELSE 'info' END AS severity, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY CAST(ts AS DATE), user_id",
}
