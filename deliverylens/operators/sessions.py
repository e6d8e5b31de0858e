"""Session journals as events: what a record means depends on the records before it.

``records`` projects journal lines on a keep-list and derives what content tells
(gates, error classes, exit codes), so content goes no further. ``resolve`` gives each
record its run, agent, skill, place and counters by windows over a session; the same is
worked out by a state machine in ``deliverylens.streaming.sessions``. ``events``
turns resolved records of either into events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deliverylens.functions import columns as C
from deliverylens.sources.events import event_time

#: The dotted paths below ``data`` that are kept, by type of record; scalars only.
KEEP = {
    "session.start": ("sessionId", "startTime", "selectedModel", "reasoningEffort", "context.repository", "context.branch", "context.gitRoot", "context.cwd", "context.headCommit", "context.baseCommit", "context.repositoryHost", "context.hostType"),
    "session.resume": ("sessionId", "resumeTime", "context.repository", "context.branch", "context.gitRoot", "context.cwd", "context.headCommit", "context.baseCommit", "context.repositoryHost", "context.hostType"),
    "session.shutdown": ("shutdownType", "sessionStartTime", "totalPremiumRequests", "totalApiDurationMs", "totalNanoAiu", "currentModel", "toolDefinitionsTokens", "systemTokens", "conversationTokens", "codeChanges.linesAdded", "codeChanges.linesRemoved"),
    "assistant.message": ("model", "outputTokens", "requestId", "turnId"),
    "assistant.turn_start": ("turnId", "interactionId"),
    "assistant.turn_end": ("turnId",),
    "tool.execution_start": ("toolCallId", "toolName", "parentToolCallId", "mcpServerName", "mcpToolName"),
    "tool.execution_complete": ("toolCallId", "success", "model", "parentToolCallId", "toolTelemetry.metrics.linesAdded", "toolTelemetry.metrics.linesRemoved", "toolTelemetry.properties.executionMode"),
    "subagent.started": ("toolCallId", "agentName", "agentDisplayName"),
    "subagent.completed": ("toolCallId",),
    "subagent.failed": ("toolCallId",),
    "skill.invoked": ("name", "source", "pluginVersion"),
    "user.message": ("interactionId", "source", "agentMode"),
    "permission.requested": ("permissionRequest.kind",),
    "permission.completed": ("result.kind",),
    "abort": ("reason",),
}
#: The leaves kept of each model's usage, by the attribute they become.
USAGE = {
    "input_tokens": "usage.inputTokens", "output_tokens": "usage.outputTokens", "cached_input_tokens": "usage.cacheReadTokens", "cache_write_tokens": "usage.cacheWriteTokens",
    "reasoning_tokens": "usage.reasoningTokens", "request_count": "requests.count", "premium_requests": "requests.cost", "nano_aiu": "totalNanoAiu",
}
WRITE_TOOLS = ("edit", "create")
AGENT, SURFACE = "copilot.cli", "copilot-cli"
#: A session without a record for so long is over; a run it left open is abandoned.
IDLE_S = 24 * 3600

RESOLVED = (
    "session_id string, record_id string, kind string, at_us long, run string, parent_run string, agent string, skill string, repo string, branch string, "
    "turn long, attempt long, tool string, server string, gate string, path string, roots array<string>, started_us long, base string, head string, host string, body string"
)


def scalar(v: Column, path: str) -> Column:
    """The text of the scalar at a dotted path of a variant; null for objects, arrays and misses."""
    at = F.try_variant_get(v, f"$.{path}", "variant")
    return F.when(~F.schema_of_variant(at).rlike("^(OBJECT|ARRAY)"), F.try_variant_get(v, f"$.{path}", "string"))


def kept(kind: Column, data: Column, keep: dict[str, tuple[str, ...]] = KEEP) -> Column:
    """map(dotted path, scalar text) of what a record's type keeps; an unknown type keeps nothing."""
    out = None
    for name, paths in keep.items():
        pairs = F.map_filter(F.create_map(*[x for p in paths for x in (F.lit(p), scalar(data, p))]), lambda _, x: x.isNotNull())
        out = F.when(kind == name, pairs) if out is None else out.when(kind == name, pairs)
    return out.otherwise(F.create_map().cast("map<string,string>"))


def records(raw: DataFrame) -> DataFrame:
    """Typed records of (session_id, value): a torn or foreign line, or one without type or time, is left out.

    Records of a session are ordered by time, then by their id.
    """
    v = F.try_parse_json("value")
    rows = raw.select("session_id", v.alias("v")).where(F.col("v").isNotNull())
    get = lambda p: F.try_variant_get("v", f"$.{p}", "string")
    rows = rows.select("session_id", scalar(F.col("v"), "id").alias("record_id"), scalar(F.col("v"), "type").alias("kind"), event_time(scalar(F.col("v"), "timestamp")).alias("at"), F.try_variant_get("v", "$.data", "variant").alias("data"), "v")
    rows = rows.where(F.col("kind").isNotNull() & F.col("at").isNotNull()).withColumn("k", kept(F.col("kind"), F.col("data")))
    k = lambda p: F.col("k")[p]
    usage = F.transform(
        F.array_sort(F.map_entries(F.from_json(F.when(F.col("kind") == "session.shutdown", F.to_json("data")), "modelMetrics map<string,string>")["modelMetrics"])),
        lambda e: F.struct(e["key"].alias("model_id"), *[F.when(~F.schema_of_variant(F.try_variant_get(F.try_parse_json(e["value"]), f"$.{p}", "variant")).rlike("^(OBJECT|ARRAY)"), F.try_variant_get(F.try_parse_json(e["value"]), f"$.{p}", "string")).alias(n) for n, p in USAGE.items()]),
    )
    success = F.lower(k("success")).try_cast("boolean")
    files = F.from_json(get("data.toolTelemetry.restrictedProperties.filePaths"), "array<string>")
    body = {
        "model": k("selectedModel"), "success": success, "error_class": F.when(~success, C.error_class(get("data.error.message"))), "code": C.exit_code(get("data.result.content")),
        "added": k("toolTelemetry.metrics.linesAdded"), "removed": k("toolTelemetry.metrics.linesRemoved"), "first_path": F.get(files, F.lit(0)), "chars": F.length(get("data.content")),
        "outcome": k("result.kind"), "api_ms": k("totalApiDurationMs"), "tool_definitions_tokens": k("toolDefinitionsTokens"), "system_tokens": k("systemTokens"), "conversation_tokens": k("conversationTokens"), "usage": usage,
    }
    call = k("toolCallId")
    name = F.coalesce(k("agentName"), k("agentDisplayName"))
    opens = F.col("kind").isin("session.start", "session.resume") | ((F.col("kind") == "subagent.started") & call.isNotNull() & name.isNotNull())
    human = ((F.col("kind") == "user.message") & (F.coalesce(k("source"), F.lit("")) == "")) | ((F.col("kind") == "permission.completed") & k("result.kind").isin("approved", "denied", "rejected")) | (F.col("kind") == "abort")
    return rows.select(
        "session_id", "record_id", "kind", "at", F.unix_micros("at").alias("at_us"),
        F.when(opens, C.derived_id("run", F.col("session_id"), F.col("record_id"))).alias("own_run"),
        call.alias("call"), k("parentToolCallId").alias("parent"), k("toolName").alias("tool"), k("mcpServerName").alias("server"),
        C.gate_of(get("data.arguments.command")).alias("gate"), get("data.arguments.path").alias("path"),
        name.alias("name"), F.when(F.col("kind") == "skill.invoked", k("name")).alias("skill"),
        k("context.repository").alias("repo"), k("context.branch").alias("branch"), k("context.baseCommit").alias("base"), k("context.headCommit").alias("head"), k("context.repositoryHost").alias("host"),
        F.array_compact(F.array(k("context.gitRoot"), k("context.cwd"))).alias("roots"),
        F.coalesce(human, F.lit(False)).alias("human"), F.to_json(F.struct(*[c.alias(n) for n, c in body.items()])).alias("body"),
    )


def resolve(rows: DataFrame, as_of_us: Column) -> DataFrame:
    """RESOLVED rows of all records by windows over their session, a plan of joins and sorts only.

    ``as_of_us`` is the clock: sessions idle for a day by then are over.
    """
    idle = F.lit(IDLE_S * 1_000_000)
    order = ["at_us", "record_id"]
    s = Window.partitionBy("session_id").orderBy(*order)
    upto, before = s.rowsBetween(Window.unboundedPreceding, 0), s.rowsBetween(Window.unboundedPreceding, -1)
    kind = F.col("kind")
    opens, shut = kind.isin("session.start", "session.resume"), kind == "session.shutdown"
    last_us = F.lag("at_us").over(s)
    r = rows.withColumn("gap", F.coalesce(F.col("at_us") - last_us >= idle, F.lit(False))).withColumn("before_us", last_us)
    run = F.struct(F.when(opens, F.col("own_run")).alias("id"), F.when(opens, F.col("at_us")).alias("at"))
    r = r.withColumn("was", F.last(F.when(opens | shut | F.col("gap"), run), True).over(before)).withColumn("epoch", F.sum(F.col("gap").cast("int")).over(upto))
    r = r.withColumn("open", F.when(~F.col("gap"), F.col("was"))).withColumn("run", F.when(opens, F.col("own_run")).otherwise(F.col("open.id")))
    least, most = F.min("skill").over(upto), F.max("skill").over(upto)
    held = {c: F.last(c, True).over(upto) for c in ("repo", "branch", "host")}
    turn = F.sum(F.col("human").cast("long")).over(upto) - 1
    r = r.withColumns(held | {"skill": F.when(least == most, least), "turn": F.when(F.col("human"), turn), "roots": F.array_distinct(F.flatten(F.collect_list("roots").over(upto)))})
    tool = kind.isin("tool.execution_start", "tool.execution_complete")
    c = Window.partitionBy("session_id", "epoch", F.when(tool, F.col("call"))).orderBy(*order)
    earlier = F.lag(F.struct("kind", "tool", "server", "gate", "path", "parent", "call")).over(c)
    met = F.when((kind == "tool.execution_complete") & F.col("call").isNotNull() & (earlier["kind"] == "tool.execution_start"), earlier)
    r = r.withColumn("start", met).withColumn("ref", F.when(kind == "tool.execution_complete", F.coalesce("start.parent", "parent")).when(kind.startswith("subagent."), F.col("call")))
    a = Window.partitionBy("session_id", "epoch", "ref").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    sub = F.when((kind == "subagent.started") & F.col("own_run").isNotNull(), F.struct("name", F.col("own_run").alias("id")))
    g = Window.partitionBy("session_id", "start.gate").orderBy(*order)
    r = r.withColumns({"sub": F.when(F.col("ref").isNotNull(), F.last(sub, True).over(a)), "attempt": F.when(F.col("start.gate").isNotNull(), F.row_number().over(g).cast("long") - 1)})
    child = kind.startswith("subagent.")
    emits = opens | shut | F.col("human") | (kind == "tool.execution_complete") | (child & F.col("sub").isNotNull() & ((kind != "subagent.started") | F.col("own_run").isNotNull()))
    none = F.lit(None).cast("string")
    facts = r.where(emits).select(
        "session_id", "record_id", "kind", "at_us",
        F.when(child | (kind == "tool.execution_complete"), F.coalesce("sub.id", "run")).otherwise(F.col("run")).alias("run"),
        F.when(child, F.col("run")).alias("parent_run"), F.coalesce("sub.name", F.lit(AGENT)).alias("agent"), "skill", "repo", "branch", "turn", "attempt",
        "start.tool", "start.server", "start.gate", "start.path", "roots", F.when(shut, F.col("open.at")).alias("started_us"), none.alias("base"), none.alias("head"), "host", "body",
    )
    # sessions that are over: at a shutdown, before a gap, and at their end if idle by now
    ends = r.withColumn("next", F.lead("gap").over(s)).withColumn("final", F.lead("at_us").over(s).isNull() & (F.col("at_us") + idle <= as_of_us))
    after = F.when(shut, none).otherwise(F.col("run"))
    lost = ends.where((F.col("next") | F.col("final")) & after.isNotNull()).select(_blank(after, F.lit("run.abandoned"), F.col("at_us") + idle))
    over = ends.where(shut | F.col("next") | F.col("final")).groupBy("session_id").agg(F.max(F.struct(*order)).alias("close"), F.max_by(F.struct("at_us", "skill", "repo", "host"), F.struct(*order)).alias("c"))
    ranges = r.where(opens & F.col("branch").isNotNull()).join(over, "session_id").where(F.struct(*order) <= F.col("close"))
    ranges = ranges.groupBy("session_id", "branch").agg(
        F.min_by("base", F.when(F.col("base").isNotNull(), F.struct(*order))).alias("base"), F.max_by("head", F.when(F.col("head").isNotNull(), F.struct(*order))).alias("head"), F.first("c").alias("c")
    )
    moved = ranges.where("base != head AND c.repo IS NOT NULL").select(
        "session_id", F.lit(None).cast("string").alias("record_id"), F.lit("run.bound").alias("kind"), "c.at_us", none.alias("run"), none.alias("parent_run"), F.lit(AGENT).alias("agent"), "c.skill", "c.repo", "branch",
        *_nulls("turn", "attempt", "tool", "server", "gate", "path", "roots", "started_us"), "base", "head", "c.host", none.alias("body"),
    )
    return facts.unionByName(lost.select("x.*")).unionByName(moved)


def _nulls(*names: str) -> list[Column]:
    types = dict(f.split(" ") for f in RESOLVED.split(", "))
    return [F.lit(None).cast(types[n]).alias(n) for n in names]


def _blank(run: Column, kind: Column, at_us: Column) -> Column:
    """A resolved row that no record stands for, as struct ``x``."""
    have = {"session_id": F.col("session_id"), "record_id": run, "kind": kind, "at_us": at_us, "run": run, "agent": F.lit(AGENT), "skill": F.col("skill"), "repo": F.col("repo"), "branch": F.col("branch"), "host": F.col("host")}
    names = [f.split(" ")[0] for f in RESOLVED.split(", ")]
    return F.struct(*[have[n].alias(n) if n in have else _nulls(n)[0] for n in names]).alias("x")


def _map(**columns: Column) -> Column:
    pairs = F.create_map(*[x for n, c in columns.items() for x in (F.lit(n), c.cast("string"))])
    return F.map_filter(pairs, lambda _, x: x.isNotNull())


def _below(path: Column, roots: Column) -> Column:
    """A path below the first of the session's roots that holds it; a relative one stays, any other is null."""
    fits = F.get(F.filter(roots, lambda r: F.startswith(path, F.concat(F.rtrim(r, F.lit("/")), F.lit("/")))), F.lit(0))
    return F.when(~path.startswith("/"), path).otherwise(F.substring(path, F.length(F.rtrim(fits, F.lit("/"))) + 2, F.length(path)))


def events(resolved: DataFrame, artifact: dict[str, str] = C.ARTIFACT_TYPES) -> DataFrame:
    """Events of resolved records; each id is derived from the session and the record, so a journal read twice gives the same ones.

    Of events with one id (a binding is told anew whenever its session is over) the last stays.
    """
    b = F.from_json(
        "body",
        "model string, success boolean, error_class string, code int, added string, removed string, first_path string, chars long, outcome string, api_ms string, tool_definitions_tokens string, system_tokens string, "
        f"conversation_tokens string, usage array<struct<model_id string, {', '.join(n + ' string' for n in USAGE)}>>",
    )
    r = resolved.withColumn("b", b)
    kind, path = F.col("kind"), _below(F.coalesce("path", "b.first_path"), F.col("roots"))
    one = F.size("b.usage") == 1

    def event(name: Column | str, suffix: Column | str, confidence: float, attributes: Column, method: str = "heuristic") -> Column:
        lit = lambda x: F.lit(x) if isinstance(x, str) else x
        return F.struct(lit(name).alias("event_type"), lit(suffix).alias("suffix"), F.lit(method).alias("method"), F.lit(confidence).alias("confidence"), attributes.alias("attributes"))

    turn_kind = F.when(kind == "abort", "correction").when(F.col("b.outcome") == "approved", "approval").when(F.col("b.outcome").isNotNull(), "rejection")
    source = F.when(kind == "session.resume", "resume").when(kind == "session.start", "start").otherwise("subagent")
    human = _map(turn_index=F.col("turn"), turn_kind=turn_kind, chars=F.col("b.chars"))
    started = _map(invocation_mode=F.lit("unknown"), model_declared_id=F.col("b.model"), input_source=source)
    call = event("tool.call", "tool.call", 0.8, _map(tool_name=F.coalesce("tool", F.lit("unknown")), tool_kind=C.tool_kind(F.coalesce("tool", F.lit("unknown")), F.col("server")), status=F.when(F.col("b.success"), "ok").when(~F.col("b.success"), "error"), error_class=F.when(~F.col("b.success"), F.col("b.error_class"))))
    gate = event("gate.evaluated", F.concat(F.lit("gate:"), "gate"), 0.6, _map(gate_name=F.col("gate"), status=F.when(F.col("b.code") == 0, "pass").when(F.col("b.code").isNotNull(), "fail"), attempt_index=F.col("attempt")))
    out = event("output.generated", "output", 0.7, _map(output_id=C.derived_id("out", F.col("session_id"), F.col("record_id"), path), artifact_type=C.first_match(path, artifact, "code"), file_path=path, lines_added=F.col("b.added"), lines_removed=F.col("b.removed")))
    wrote = F.col("tool").isin(*WRITE_TOOLS) & F.col("b.success") & (path != "")
    models = F.transform("b.usage", lambda u: event(
        "model.call", F.concat(F.lit("model:"), u["model_id"]), 0.8,
        _map(model_id=u["model_id"], **{n: u[n] for n in USAGE}, **{n: F.when(one, F.col(f"b.{c}")) for n, c in (("latency_ms", "api_ms"), ("tool_definitions_tokens", "tool_definitions_tokens"), ("system_tokens", "system_tokens"), ("conversation_tokens", "conversation_tokens"))}),
    ))
    ran = _map(duration_ms=F.when(F.col("started_us").isNotNull(), F.floor((F.col("at_us") - F.col("started_us")) / 1000)))
    ended = F.when(F.col("run").isNotNull(), F.array(event("run.completed", "run:end", 0.9, ran))).otherwise(F.array().cast("array<struct<event_type string, suffix string, method string, confidence double, attributes map<string,string>>>"))
    human_confidence = F.when(kind == "user.message", 0.8).otherwise(0.9)
    made = (
        F.when(kind.isin("session.start", "session.resume"), F.array(event("run.started", "run.started", 0.9, started)))
        .when(kind == "subagent.started", F.array(event("run.started", "run:subagent", 0.9, started)))
        .when(kind == "subagent.completed", F.array(event("run.completed", "run:subagent_end", 0.9, _map())))
        .when(kind == "subagent.failed", F.array(event("run.failed", "run:subagent_end", 0.9, _map(failure_class=F.lit("subagent_failed"), dependency_failed=F.lit("none")))))
        .when(kind == "tool.execution_complete", F.array_compact(F.array(call, F.when(F.col("gate").isNotNull(), gate), F.when(wrote, out))))
        .when(kind.isin("user.message", "permission.completed", "abort"), F.array(event("human.turn", "human.turn", 0.8, human)))
        .when(kind == "session.shutdown", F.concat(ended, F.coalesce(models, F.array().cast("array<struct<event_type string, suffix string, method string, confidence double, attributes map<string,string>>>"))))
        .when(kind == "run.abandoned", F.array(event("run.abandoned", "run:abandoned", 0.9, _map(reason=F.lit("idle")))))
        .when(kind == "run.bound", F.array(event("run.bound", F.concat(F.lit("run:bound:"), "branch"), 1.0, _map(copilot_session_id=F.col("session_id"), base_commit_sha=F.col("base"), head_commit_sha=F.col("head"), repository_host=F.col("host")), "explicit")))
    )
    rows = r.select("*", F.explode(made).alias("e"), human_confidence.alias("hc"))
    rows = rows.select(
        C.derived_id("evt", F.col("session_id"), F.col("record_id"), F.col("e.suffix")).alias("event_id"), "e.event_type", F.timestamp_micros("at_us").alias("event_time"), F.col("session_id").alias("trace_id"),
        F.when(F.col("e.event_type") != "model.call", F.col("run")).alias("run_id"), F.col("parent_run").alias("parent_run_id"), F.col("agent").alias("agent_name"), F.lit(SURFACE).alias("surface"), F.col("skill").alias("skill_name"),
        F.col("repo").alias("repo_full_name"), F.col("branch").alias("branch_name"), F.col("e.method").alias("link_method"), F.when(F.col("e.event_type") == "human.turn", F.col("hc")).otherwise(F.col("e.confidence")).alias("link_confidence"),
        F.to_json(F.map_from_entries(F.array_sort(F.map_entries("e.attributes")))).alias("attributes"),
    )
    names = rows.columns[1:]
    return rows.groupBy("event_id").agg(F.max_by(F.struct(*names), F.struct("event_time", "attributes")).alias("x")).select("event_id", "x.*")
