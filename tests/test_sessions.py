"""Session journals to events: by windows, by the stream's state machine, and by literal rows."""

import json
import random

import pytest
from pyspark.sql import functions as F

from deliverylens.operators import sessions
from deliverylens.streaming import sessions as stream

T0 = 1_700_000_000
DAY = 86_400


def line(at, rid, kind, **data):
    stamp = f"{__import__('datetime').datetime.fromtimestamp(at, __import__('datetime').timezone.utc):%Y-%m-%dT%H:%M:%S}Z"
    return json.dumps({"id": rid, "type": kind, "timestamp": stamp, "data": data})


def context(branch, base, head, root="/home/x/repo"):
    return {"repository": "org/r", "branch": branch, "baseCommit": base, "headCommit": head, "gitRoot": root, "repositoryHost": "h"}


ONE = [
    line(T0, "r1", "session.start", selectedModel="m", context=context("main", "aaa", "aaa"), secretText="never kept"),
    line(T0 + 1, "r2", "user.message", content="hello"),
    line(T0 + 2, "r3", "user.message", content="injected", source="hook"),
    line(T0 + 3, "r4", "tool.execution_start", toolCallId="c1", toolName="bash", arguments={"command": "pytest -q"}),
    line(T0 + 4, "r5", "tool.execution_complete", toolCallId="c1", success=True, result={"content": "1 failed\n<exited with exit code 1>"}),
    line(T0 + 5, "r6", "subagent.started", toolCallId="t1", agentName="reviewer"),
    line(T0 + 6, "r7", "tool.execution_start", toolCallId="c2", toolName="edit", parentToolCallId="t1", arguments={"path": "/home/x/repo/src/a.py"}),
    line(T0 + 7, "r8", "tool.execution_complete", toolCallId="c2", success=True, toolTelemetry={"metrics": {"linesAdded": 0, "linesRemoved": {"no": 1}}}),
    line(T0 + 8, "r9", "tool.execution_complete", toolCallId="c2", success=False, error={"message": "no match found"}),
    line(T0 + 9, "ra", "subagent.failed", toolCallId="t1"),
    line(T0 + 10, "rb", "skill.invoked", name="tidy"),
    line(T0 + 11, "rc", "permission.completed", result={"kind": "approved"}),
    line(T0 + 12, "rd", "session.resume", context=context("feat", "aaa", "bbb")),
    line(T0 + 13, "re", "abort", reason="user"),
    line(T0 + 14, "rf", "session.shutdown", totalApiDurationMs=900, systemTokens=5, modelMetrics={"m-1": {"requests": {"count": 2, "cost": 1}, "usage": {"inputTokens": 10, "outputTokens": {"x": 1}}}}),
    '{"id": "rg", "type": "user.mess',
    "[]",
    line(T0 + 15, "rh", "something.new", name="x"),
]


def batch(spark, sessions_lines, as_of):
    raw = spark.createDataFrame([(s, v) for s, lines in sessions_lines.items() for v in lines], "session_id string, value string").repartition(3)
    return sessions.events(sessions.resolve(sessions.records(raw), F.lit(as_of * 1_000_000)))


def test_a_journal_becomes_its_events(spark):
    rows = batch(spark, {"s1": ONE}, T0 + 100).orderBy("event_time", "event_type").collect()
    got = [(r.event_type, r.agent_name, r.skill_name, r.branch_name, json.loads(r.attributes)) for r in rows]
    assert [g[0] for g in got] == [
        "run.started", "human.turn", "gate.evaluated", "tool.call", "run.started", "output.generated", "tool.call", "tool.call",
        "run.failed", "human.turn", "run.started", "human.turn", "model.call", "run.bound", "run.completed",
    ]
    assert got[0][4] == {"input_source": "start", "invocation_mode": "unknown", "model_declared_id": "m"}
    assert got[1][4] == {"turn_index": "0", "chars": "5"}
    assert got[2][4] == {"gate_name": "test", "status": "fail", "attempt_index": "0"} and got[3][4]["tool_kind"] == "terminal"
    assert got[5][1] == "reviewer" and got[5][4]["file_path"] == "src/a.py" and got[5][4]["lines_added"] == "0" and "lines_removed" not in got[5][4]
    assert got[7][4] == {"tool_name": "unknown", "tool_kind": "other", "status": "error", "error_class": "not_found"} and got[7][1] == "copilot.cli"
    assert [g[4].get("turn_kind") for g in got if g[0] == "human.turn"] == [None, "approval", "correction"]
    assert got[12][4] == {"model_id": "m-1", "input_tokens": "10", "request_count": "2", "premium_requests": "1", "latency_ms": "900", "system_tokens": "5"}
    assert got[13][2:4] == ("tidy", "feat") and got[13][4]["head_commit_sha"] == "bbb"
    assert got[14][4] == {"duration_ms": "2000"}
    runs = [r.run_id for r in rows if r.event_type == "run.started"]
    assert len(set(runs)) == 3 and rows[8].run_id == runs[1] and rows[8].parent_run_id == runs[0] and rows[14].run_id == runs[2]
    assert "never kept" not in str(rows) and "hello" not in str(rows)


def wild(seed, session):
    """A journal with gaps of days, calls that never end, and shutdowns at any place."""
    r = random.Random(seed)
    at, out = T0 + seed, []
    for k in range(60):
        at += r.choice([1, 1, 1, 60, 3_600, 90_000])
        rid = f"{session}{k:03d}"
        call = r.choice(["c1", "c2", "c3", "t1", "t2"])
        kind = r.choice(["session.start", "session.resume", "user.message", "tool.execution_start", "tool.execution_complete", "tool.execution_start", "tool.execution_complete", "subagent.started", "subagent.completed", "skill.invoked", "abort", "session.shutdown"])
        data = {"toolCallId": call}
        if kind in ("session.start", "session.resume"):
            data = {"context": {"repository": "org/r", "branch": r.choice(["main", "feat", None]), "baseCommit": r.choice(["a", "b", None]), "headCommit": r.choice(["c", "d", None]), "gitRoot": r.choice(["/w/a", "/w/b"])}}
        elif kind == "tool.execution_start":
            data |= {"toolName": r.choice(["bash", "edit"]), "parentToolCallId": r.choice([None, "t1", "t2"]), "arguments": {"command": r.choice(["pytest", "ls", "ruff ."]), "path": r.choice(["x.py", "/w/a/y.md", "/z/q"])}}
        elif kind == "tool.execution_complete":
            data |= {"success": r.random() < 0.8, "parentToolCallId": r.choice([None, "t1"]), "result": {"content": "<exited with exit code 0>"}}
        elif kind == "subagent.started":
            data |= {"agentName": r.choice(["one", "two"])}
        elif kind == "skill.invoked":
            data = {"name": r.choice(["tidy", "tidy", "plan"]) if seed % 2 else "tidy"}
        elif kind == "session.shutdown":
            data = {"modelMetrics": {"m": {"usage": {"inputTokens": k}}}}
        out.append((at, line(at, rid, kind, **data)))
    return out


@pytest.mark.parametrize("cuts", [1, 3])
def test_the_stream_gives_the_batch_events(spark, tmp_path, cuts):
    """Written journals, taken in at once or in pieces with a restart in between: the same events."""
    all_lines = {f"s{k}": wild(k, f"s{k}") for k in range(8)}
    end = max(at for lines in all_lines.values() for at, _ in lines)
    last = end + 10 * DAY
    edges = [T0 - 1, *[T0 + (end - T0) * k // cuts for k in range(1, cuts)], last]
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    (tmp_path / "src").mkdir()
    raw = spark.readStream.schema("session_id string, value string").json(src)
    for a, b in zip(edges, edges[1:]):
        part = [(s, v) for s, lines in all_lines.items() for at, v in lines if a < at <= b]
        if b == last:
            part.append(("clock", line(last, "z", "user.message", content="tick")))
        spark.createDataFrame(part, "session_id string, value string").coalesce(1).write.mode("append").json(src)
        stream.run_facts(raw, "1 hour", out, state)
    got = stream.stored_events(spark.read.parquet(out))
    lines = {s: [v for _, v in x] for s, x in all_lines.items()} | {"clock": [line(last, "z", "user.message", content="tick")]}
    want = batch(spark, lines, last - 3_600)
    assert want.where("event_type = 'run.abandoned'").count() > 8 and want.where("event_type = 'run.bound'").count() > 3
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_no_records(spark):
    assert batch(spark, {"s": ["", "{}", '{"type": 3}']}, T0).collect() == []
