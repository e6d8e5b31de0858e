"""Chat logs that are written as patches, replayed to the last state of each request, and their events.

A log is never folded row by row. What a kept path of a request says at the end is decided by
the last patch that reached it: one at the path itself or at any path above it. So
each kept path is one aggregate (the value of the last such patch) and a request's
tool rounds are the last array set and what was pushed after it; sessions need no
order but that of their lines, and no document is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deliverylens.functions import columns as C
from deliverylens.operators.sessions import scalar

#: The paths of a request that are kept (scalars only), and the one that is read for keys and dropped.
KEEP = {
    "model_id": "modelId", "at_ms": "timestamp", "response_ms": "responseTimestamp", "waited_ms": "timeSpentWaiting", "elapsed_ms": "result.timings.totalElapsed", "first_ms": "result.timings.firstProgress",
    "agent_id": "result.metadata.agentId", "exceeded": "result.metadata.maxToolCallsExceeded", "prompt_tokens": "result.metadata.promptTokens", "output_tokens": "result.metadata.outputTokens", "resolved_model": "result.metadata.resolvedModel",
}
SCANNED = "message.text"
ROUNDS = "result.metadata.toolCallRounds"
#: Kinds of tools by exact name.
TOOL_KINDS = {
    "read_file": "read", "list_dir": "read", "get_errors": "read", "grep_search": "search", "file_search": "search", "semantic_search": "search", "create_file": "edit",
    "replace_string_in_file": "edit", "multi_replace_string_in_file": "edit", "run_in_terminal": "execute", "runSubagent": "delegate", "manage_todo_list": "plan",
}
SET, PUSH, DELETE = 1, 2, 3


def _above(path: str) -> list[tuple[str, str]]:
    """(path above or equal, what is left below it) of a dotted path, the request itself first."""
    parts = path.split(".")
    return [(".".join(parts[:k]), ".".join(parts[k:])) for k in range(len(parts) + 1)]


def _op(path: str, value) -> Column:
    """struct(known, x) where a patch settles the path: ``value(v, rest)`` of it, null if deleted; else null."""
    out = F.when((F.col("op") == 0) & F.col("has").contains(f"|{path.split('.')[0]}|"), F.struct(value(F.col("v"), path).alias("x")))
    for above, rest in _above(path):
        at = F.col("path") == above
        out = out.when(at & (F.col("op") == DELETE), F.struct(F.lit(None).cast("string").alias("x")))
        out = out.when(at & (F.col("op") == SET), F.struct(value(F.col("v"), rest).alias("x")))
    return out


def _scalar(v: Column, rest: str) -> Column:
    if rest:
        return scalar(v, rest)
    return F.when(~F.schema_of_variant(v).rlike("^(OBJECT|ARRAY)"), F.try_variant_get(v, "$", "string"))


def _json(v: Column, rest: str) -> Column:
    return F.to_json(F.try_variant_get(v, f"$.{rest}" if rest else "$", "variant"))


def replay(lines: DataFrame) -> DataFrame:
    """A row for each request of (session_id, line_no, value): session_id, request_id, place, the KEEP columns, said, calls.

    A line is ``{"v": {"requests": [..]}}`` or ``{"k": ["requests"], "v": [..]}`` (requests seen again
    give their keys anew), or a patch ``{"kind": 1|2|3, "k": ["requests", place, ..], "v": ..}``
    that sets, pushes to or deletes what lies at the path; a push counts at the tool rounds. A request's
    place is its rank of first sighting; one that is deleted as a whole has no row, and
    leaves the others' places as they are (what is set in it later counts if it is seen again). Torn lines, requests without an id and patches
    of places that don't exist are left out. Patches inside a tool round are left out.
    """
    v = F.try_parse_json("value")
    r = lines.select("session_id", "line_no", v.alias("v")).where(F.col("v").isNotNull())
    r = r.select("session_id", "line_no", F.from_json(F.to_json(F.try_variant_get("v", "$.k", "variant")), "array<string>").alias("k"), F.try_variant_get("v", "$.kind", "int").alias("kind"), F.try_variant_get("v", "$.v", "variant").alias("v"))
    shape = F.schema_of_variant("v")
    whole = F.coalesce(F.size("k") <= 1, F.lit(True))
    listed = F.when(shape.startswith("ARRAY"), F.to_json("v")).otherwise(F.to_json(F.try_variant_get("v", "$.requests", "variant")))
    items = r.where(whole).select("session_id", "line_no", F.posexplode(F.from_json(listed, "array<string>")).alias("pos", "item"))
    items = items.select("session_id", "line_no", "pos", F.try_parse_json("item").alias("v"), F.concat(F.lit("|"), F.array_join(F.json_object_keys("item"), "|"), F.lit("|")).alias("has"))
    items = items.withColumn("request_id", scalar(F.col("v"), "requestId")).where("request_id IS NOT NULL")
    order = F.struct("line_no", "pos")
    places = items.groupBy("session_id", "request_id").agg(F.min(order).alias("first"))
    places = places.select("session_id", "request_id", (F.row_number().over(Window.partitionBy("session_id").orderBy("first")) - 1).alias("place"))
    patches = r.where(~whole & (F.get("k", F.lit(0)) == "requests")).select("session_id", "line_no", F.get("k", F.lit(1)).try_cast("int").alias("place"), F.array_join(F.slice("k", 3, 100), ".").alias("path"), "kind", "v")
    patches = patches.join(places, ["session_id", "place"])
    none = F.lit(None).cast("string")
    ops = items.select("session_id", "request_id", "line_no", "pos", F.lit(0).alias("op"), none.alias("path"), "has", "v")
    ops = ops.unionByName(patches.select("session_id", "request_id", "line_no", F.lit(0).alias("pos"), F.coalesce("kind", F.lit(SET)).alias("op"), "path", none.alias("has"), "v"))

    def last(found: Column) -> Column:
        return F.max_by(found, F.when(found.isNotNull(), order))["x"]

    rounds = F.when((F.col("op") == PUSH) & (F.col("path") == ROUNDS), F.struct(F.lit(True).alias("push"), F.to_json("v").alias("x")))
    settled = _op(ROUNDS, _json)
    rounds = F.coalesce(rounds, F.when(settled.isNotNull(), F.struct(F.lit(False).alias("push"), settled["x"].alias("x"))))
    gone = F.max(F.when((F.col("op") == DELETE) & (F.col("path") == ""), order)) > F.max(F.when((F.col("op") == 0) | ((F.col("op") == SET) & (F.col("path") == "")), order))
    out = ops.groupBy("session_id", "request_id").agg(
        *[last(_op(p, _scalar)).alias(n) for n, p in KEEP.items()],
        last(_op(SCANNED, _scalar)).alias("said"),
        F.array_sort(F.collect_list(F.when(rounds.isNotNull(), F.struct("line_no", "pos", rounds.alias("r"))))).alias("rounds"),
        F.coalesce(gone, F.lit(False)).alias("gone"),
    )
    texts = "array<struct<toolCalls array<struct<name string, arguments string>>>>"
    empty = F.array().cast(texts)
    array_of = lambda x: F.coalesce(F.from_json(F.when(F.startswith(x, F.lit("[")), x).otherwise(F.concat(F.lit("["), x, F.lit("]"))), texts), empty)
    folded = F.aggregate("rounds", empty, lambda acc, p: F.when(p["r"]["push"], F.concat(acc, array_of(p["r"]["x"]))).otherwise(array_of(p["r"]["x"])))
    calls = F.filter(F.flatten(F.transform(folded, lambda x: F.coalesce(x["toolCalls"], F.array().cast("array<struct<name string, arguments string>>")))), lambda c: c["name"] != "")
    return out.where("NOT gone").join(places, ["session_id", "request_id"]).select("session_id", "request_id", "place", *KEEP, "said", calls.alias("calls"))


def chat_events(requests: DataFrame, branches: DataFrame, projects: Sequence[str]) -> DataFrame:
    """Turns, model calls and tool calls of replayed requests, each with how its keys were found.

    branches: (session_id, request_id, branch), as the checkout's history tells it; a missing
    one is unknown. Keys are those of the branch (confidence 0.9); only if it names none,
    those of the prompt (0.5, the text goes no further); a tool call whose path names a test
    fills what is missing (0.7). ``key_route`` says which: branch, prompt, path or null.
    """
    b = branches.select("session_id", "request_id", "branch")
    r = requests.join(b, ["session_id", "request_id"], "left")
    named = lambda text: F.struct(C.issue_key([text], projects).alias("jira"), C.test_keys([text], projects).alias("t"))
    any_of = lambda k: k["jira"].isNotNull() | k["t"]["case_key"].isNotNull() | k["t"]["cycle_key"].isNotNull()
    r = r.withColumn("kb", named(F.col("branch"))).withColumn("kp", named(F.col("said")))
    by_branch, by_prompt = any_of(F.col("kb")), any_of(F.col("kp"))
    keys = F.when(by_branch, F.col("kb")).when(by_prompt, F.col("kp")).otherwise(F.col("kb"))
    r = r.withColumns({"keys": keys, "route": F.when(by_branch, "branch").when(by_prompt, "prompt"), "at": F.timestamp_millis(F.col("at_ms").try_cast("double").cast("long"))}).drop("said", "kb", "kp")
    plain = F.when(F.col("route") == "prompt", 0.5).otherwise(0.9)
    number = lambda c: F.col(c).try_cast("long")
    fields = "event_type string, position int, name string, kind string, model_id string, input_tokens long, output_tokens long, latency_ms long, finish_reason string, paths array<string>"
    names = [f.split(" ")[0] for f in fields.split(", ")]
    types = dict(f.split(" ") for f in fields.split(", "))

    def row(**have: Column) -> Column:
        return F.struct(*[have.get(n, F.lit(None)).cast(types[n]).alias(n) for n in names])

    turn = row(event_type=F.lit("human.turn"), position=F.col("place"), kind=F.lit("prompt"))
    model = C.model_name(F.nullif(F.coalesce("resolved_model", "model_id"), F.lit("")))
    call = row(event_type=F.lit("model.call"), model_id=model, input_tokens=number("prompt_tokens"), output_tokens=number("output_tokens"), latency_ms=number("elapsed_ms"), finish_reason=F.when(F.lower("exceeded") == "true", "max_tool_calls"))
    kinds = F.create_map(*[F.lit(x) for kv in TOOL_KINDS.items() for x in kv])
    paths = lambda c: F.array_compact(F.array(*[F.get_json_object(c["arguments"], f"$.{p}") for p in ("filePath", "path", "uri")]))
    tools = F.transform("calls", lambda c, k: row(event_type=F.lit("tool.call"), position=k, name=c["name"], kind=F.coalesce(kinds[c["name"]], F.lit("other")), paths=paths(c)))
    e = r.select("*", F.explode(F.concat(F.array(turn, call), tools)).alias("e"))
    on_path = C.test_keys([F.get("e.paths", F.lit(k)) for k in range(3)], projects)
    e = e.withColumn("p", F.when(F.col("e.event_type") == "tool.call", on_path))
    fills = (F.col("p.case_key").isNotNull() & F.col("keys.t.case_key").isNull()) | (F.col("p.cycle_key").isNotNull() & F.col("keys.t.cycle_key").isNull())
    fills = F.coalesce(fills, F.lit(False))
    suffix = F.when(F.col("e.event_type") == "human.turn", F.concat(F.lit("turn:"), "request_id")).when(F.col("e.event_type") == "model.call", F.concat(F.lit("model:"), "request_id")).otherwise(F.concat_ws(":", F.lit("tool"), "request_id", F.col("e.position").cast("string")))
    return e.select(
        C.derived_id("evt", F.col("session_id"), suffix).alias("event_id"), "e.event_type", F.col("at").alias("event_time"), F.col("session_id").alias("trace_id"), F.col("branch").alias("branch_name"),
        F.col("keys.jira").alias("jira_issue_key"), F.coalesce("keys.t.case_key", F.when(fills, F.col("p.case_key"))).alias("test_case_key"), F.coalesce("keys.t.cycle_key", F.when(fills, F.col("p.cycle_key"))).alias("test_cycle_key"),
        F.when(fills, "path").otherwise(F.col("route")).alias("key_route"), F.when(fills, 0.7).otherwise(plain).alias("link_confidence"),
        F.when(F.col("e.event_type") == "human.turn", F.col("e.position")).alias("turn_index"), F.col("e.name").alias("tool_name"), F.col("e.kind").alias("kind"),
        "e.model_id", "e.input_tokens", "e.output_tokens", "e.latency_ms", "e.finish_reason",
    )
