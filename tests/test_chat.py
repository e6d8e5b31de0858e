"""Chat logs of patches against a document that is patched line by line, and literal events."""

import json
import random

from pyspark.sql import functions as F

from deliverylens.operators import chat


def patched(lines):
    """The requests that a log leaves, each document patched in the order of its lines."""
    places, docs, gone = [], {}, set()
    for text in lines:
        try:
            line = json.loads(text)
        except ValueError:
            continue
        k, v = line.get("k") or [], line.get("v")
        if len(k) <= 1:
            for item in v if isinstance(v, list) else (v or {}).get("requests") or []:
                if item.get("requestId"):
                    if item["requestId"] not in places:
                        places.append(item["requestId"])
                    docs.setdefault(item["requestId"], {})
                    gone.discard(item["requestId"])
                    docs[item["requestId"]].update(json.loads(json.dumps(item)))
            continue
        if k[1] >= len(places):
            continue
        rid, path, kind = places[k[1]], k[2:], line["kind"]
        if not path:
            docs[rid] = {} if kind == 3 else v
            (gone.add if kind == 3 else gone.discard)(rid)
            continue
        node = docs[rid]
        for p in path[:-1]:
            if not isinstance(node.get(p), dict):
                node[p] = {}
            node = node[p]
        if kind == 3:
            node.pop(path[-1], None)
        elif kind == 2:
            node[path[-1]] = (node.get(path[-1]) if isinstance(node.get(path[-1]), list) else []) + v
        else:
            node[path[-1]] = v
    return {r: (places.index(r), docs[r]) for r in places if r not in gone}


def dig(node, path):
    for p in path.split("."):
        node = node.get(p) if isinstance(node, dict) else None
    return node


def rounds(r, n):
    return [{"toolCalls": [{"name": r.choice(["read_file", "create_file", "zap"]), "arguments": {"filePath": f"/x/{r.randrange(9)}"}} for _ in range(r.randrange(3))]} for _ in range(n)]


def log(seed):
    r = random.Random(seed)
    out = [json.dumps({"kind": 0, "v": {"requests": [{"requestId": "q0", "modelId": "a/m-1-2", "timestamp": 1_700_000_000_000}]}})]
    n = 1
    for k in range(40):
        at = r.randrange(n + 1)
        what = r.randrange(9)
        if what == 0:
            out.append(json.dumps({"kind": 2, "k": ["requests"], "v": [{"requestId": f"q{n}", "timestamp": 1_700_000_000_000 + k, "result": {"metadata": {"promptTokens": k}}}]}))
            n += 1
        elif what == 1:
            out.append(json.dumps({"kind": 2, "k": ["requests"], "v": [{"requestId": f"q{r.randrange(n)}", "modelId": f"m{k}"}, {"no": "id"}]}))
        elif what == 2:
            out.append(json.dumps({"kind": 1, "k": ["requests", at, "result"], "v": {"timings": {"totalElapsed": k}, "metadata": {"outputTokens": k, "toolCallRounds": rounds(r, 2)}}}))
        elif what == 3:
            out.append(json.dumps({"kind": 1, "k": ["requests", at, "result", "metadata", "promptTokens"], "v": r.choice([k, {"nested": k}, None])}))
        elif what == 4:
            out.append(json.dumps({"kind": 2, "k": ["requests", at, "result", "metadata", "toolCallRounds"], "v": rounds(r, 1)}))
        elif what == 5:
            out.append(json.dumps({"kind": 3, "k": ["requests", at, "result", *r.choice([[], ["metadata"], ["metadata", "outputTokens"]])]}))
        elif what == 6:
            out.append(json.dumps({"kind": 1, "k": ["requests", at, "message"], "v": {"text": f"see IML-{k}"}}))
        elif what == 7 and r.random() < 0.3:
            out.append(json.dumps({"kind": 3, "k": ["requests", at]}))
        else:
            out.append('{"kind": 1, "k": ["requ')
    return out


def test_replay_equals_patching_documents(spark):
    logs = {f"s{k}": log(k) for k in range(40)}
    rows = [(s, n, v) for s, lines in logs.items() for n, v in enumerate(lines)]
    got = {(r.session_id, r.request_id): r for r in chat.replay(spark.createDataFrame(rows, "session_id string, line_no int, value string").repartition(4)).collect()}
    want = {(s, q): x for s, lines in logs.items() for q, x in patched(lines).items()}
    assert got.keys() == want.keys() and len(want) > 100
    for key, (place, doc) in want.items():
        r = got[key]
        assert r.place == place
        for name, path in chat.KEEP.items():
            value = dig(doc, path)
            assert r[name] == (None if value is None or isinstance(value, (dict, list)) else str(value)), (key, name)
        calls = [c for x in dig(doc, chat.ROUNDS) or [] for c in x["toolCalls"]]
        assert [c.name for c in r.calls] == [c["name"] for c in calls]


def test_keys_come_from_branch_then_prompt_then_path(spark):
    def request(q, text, files):
        return {"requestId": q, "timestamp": 1_700_000_000_000, "message": {"text": text}, "result": {"metadata": {"resolvedModel": "x/m-4-5", "toolCallRounds": [{"toolCalls": [{"name": "create_file", "arguments": {"filePath": f, "content": "IML-TC-9"}} for f in files]}]}}}

    line = json.dumps({"v": {"requests": [request("a", "IML-7 and ERR-500", ["/t/IML-TC-5.ts"]), request("b", "IML-TC-3, see IML-8", ["/t/IML-TC-5.ts", "/t/IML-CY-2/x"]), request("c", "nothing", [])]}})
    r = chat.replay(spark.createDataFrame([("s", 0, line)], "session_id string, line_no int, value string"))
    branches = spark.createDataFrame([("s", "a", "feat/IML-1")], "session_id string, request_id string, branch string")
    e = chat.chat_events(r, branches, ["IML"]).where("event_type != 'human.turn'").orderBy("event_id")
    got = sorted((x.event_type, x.jira_issue_key or "", x.test_case_key or "", x.test_cycle_key or "", x.key_route or "", x.link_confidence, x.kind or "") for x in e.collect())
    assert got == sorted([
        ("model.call", "IML-1", "", "", "branch", 0.9, ""), ("model.call", "IML-8", "IML-TC-3", "", "prompt", 0.5, ""), ("model.call", "", "", "", "", 0.9, ""),
        ("tool.call", "IML-1", "IML-TC-5", "", "path", 0.7, "edit"), ("tool.call", "IML-8", "IML-TC-3", "", "prompt", 0.5, "edit"), ("tool.call", "IML-8", "IML-TC-3", "IML-CY-2", "path", 0.7, "edit"),
    ])
    assert e.where(F.col("model_id") == "m-4.5").count() == 3 and "nothing" not in str(e.collect())


def test_no_lines(spark):
    assert chat.replay(spark.createDataFrame([("s", 0, "{}"), ("s", 1, "[1]"), ("s", 2, None)], "session_id string, line_no int, value string")).collect() == []
