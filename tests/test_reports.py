"""Commits, reports, identities and usage on small rows with known answers."""

import datetime as dt
import random

from pyspark.sql import functions as F

from deliverylens.functions import columns as C
from deliverylens.operators import commits, identities, reconcile, tracker, usage

LOG = "repo string, branch string, sha string, authored timestamp, email string, message string, stats string"
AT = dt.datetime(2024, 1, 5)


def test_commit_events_of_odd_commits(spark):
    rows = [
        ("r", None, "a", AT, "X@y.z ", "AI fix\n\nAI-Run-Id: r1\nAI-RUN-ID: r2", "3\t1\tsrc/a b.py\n-\t-\timg.png\nodd line\n2\t0\ttests/t.py"),
        ("r", "main", "b", None, None, None, None), ("r", "main", None, AT, "x@y.z", "AI", "1\t1\tx"), (None, "fix/IML-7", "c", AT, "", "FAIL\nAI here", "1\t2\tx.md"), (None, "fix/IML-7", "c", AT, "", "FAIL\nAI here", "1\t2\tx.md"),
    ]
    e = commits.commit_events(spark.createDataFrame(rows, LOG), ["IML"], "s")
    got = e.select("event_type", "run_id", "context.jira_issue_key", "context.jira_project_key", "actor.person_email_hash", "link.method", "link.confidence", F.get_json_object("attributes", "$.lines_added").alias("a"), F.get_json_object("attributes", "$.file_path").alias("p"), F.get_json_object("attributes", "$.has_ai_marker").alias("m"), "event_id").collect()
    files = sorted((r.p, r.a, r.run_id, r.method, r.confidence) for r in got if r.event_type == "output.generated")
    assert files == [("src/a b.py", "3", "r2", "explicit", 1.0), ("tests/t.py", "2", "r2", "explicit", 1.0)]
    whole = [r for r in got if r.event_type == "scm.commit"]
    assert sorted((r.run_id or "", r.jira_issue_key or "", r.jira_project_key or "", r.a, r.m, r.confidence) for r in whole) == [("", "", "", "0", "false", 0.3), ("", "IML-7", "IML", "1", "false", 0.3), ("", "IML-7", "IML", "1", "false", 0.3), ("r2", "", "", "5", "true", 1.0)]
    assert len({r.event_id for r in got}) == 5  # the commit told twice is one event
    assert sum(r.person_email_hash is not None for r in got) == 1
    assert e.where(commits.envelope_fault(e).isNotNull()).isEmpty()
    assert e.drop("link").select(commits.envelope_fault(e.drop("link"))).first()[0] == "keys:link"
    assert commits.commit_events(spark.createDataFrame([], LOG), [], None).isEmpty()


def test_leaks_are_told_by_name_and_hold_back_only_their_event(spark):
    rows = [("1", "t", '{"a": "/home/me/x"}'), ("2", "t", '{"a": "ok", "b": 1}'), ("3", "t", '{"a": "%s"}' % ("x" * 201)), ("4", "t", '{"a": "see /Users/me"}'), ("5", "u", '{"a": "ok"}'), ("6", "t", '{"a": "/homes/x"}'), ("7", "t", None), ("8", "t", "[1]"), ("9", None, "{}")]
    e = spark.createDataFrame(rows, "event_id string, event_type string, attributes string")
    leaks = commits.content_leaks(e, {"t": ["a"]})
    assert sorted((r.event_id, r.problem) for r in leaks.collect()) == [("1", "absolute path"), ("2", "not allowed"), ("3", "long value"), ("4", "absolute path"), ("5", "unknown type"), ("9", "unknown type")]
    assert sorted(r.event_id for r in commits.shippable(e, leaks).collect()) == ["6", "7", "8"]


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_near_names_equal_comparing_all_pairs(spark):
    rnd = random.Random(5)
    names = set()
    for _ in range(40):
        s = "".join(rnd.choice("abc1") for _ in range(rnd.choice((3, 4, 5, 9, 13, 14, 15, 16, 17, 18, 25, 31))))
        for _ in range(6):
            t = list(s)
            for _ in range(rnd.randint(0, 3)):
                k = rnd.randrange(len(t) + 1)
                if rnd.random() < 0.5 or len(t) < 3:
                    t.insert(k, rnd.choice("abc1"))
                else:
                    del t[k - 1]
            names.add("".join(t))
    rows = [(n, f"m{rnd.randrange(150)}@x") for n in sorted(names)] + [("a b.c1", " M1@x "), (None, "m2@x"), ("", "m3@x"), ("abcd", None), ("abcd", " ")]
    who = identities.authors(spark.createDataFrame(rows, "name string, email string"))
    mails = {}
    for r in who.collect():
        mails.setdefault(r.norm, set()).add(r.email)
    keys = sorted(k for k in mails if len(k) >= 4)
    want = {(a, b, _edits(a, b)) for a in keys for b in keys if a < b and not mails[a] & mails[b] and abs(len(a) - len(b)) <= 2 and _edits(a, b) <= 2}
    got = [tuple(r) for r in identities.near_names(who).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert {len(a) > 16 for a, _, _ in want} == {True, False}


def test_reconciliation_of_odd_reports(spark):
    reports = spark.createDataFrame([("I1", "C1", "2024-01-05"), ("I1", "C1", "2024-01-05"), ("I1", "C1", "soon"), ("I2", "C1", "2024-01-05"), ("I3", "", "2024-01-09"), (None, None, None)], "issue_key string, case_key string, day string")
    day = lambda d: dt.date(2024, 1, d)
    trail = lambda rows: spark.createDataFrame(rows, "key string, day date")
    issues, cases = trail([("I1", day(4)), ("I1", day(6)), ("I2", day(7)), (None, day(5)), ("I3", None)]), trail([("C1", day(5)), ("C1", day(5))])
    rows = reconcile.judged(reports, issues, cases)
    got = {r.issue_key: (r.observations, r.both_trails_agree, r.days, r.confidence) for r in reconcile.mappings(rows).collect()}
    assert got == {"I1": (3, 2, [day(5)], "corroborated"), "I2": (1, 0, [day(5)], "reported_only")}
    assert tuple(reconcile.completeness(rows, issues).first()) == (6, 2, 4, 33.3, 3, 2)
    assert reconcile.mappings(reconcile.judged(reports, issues, cases, tolerance=2)).where("confidence = 'corroborated'").count() == 2
    none = reconcile.judged(reports.limit(0), issues, cases)
    assert tuple(reconcile.completeness(none, issues).first()) == (0, 0, 0, None, 0, 0)


def test_a_session_with_one_unpriced_model_has_no_cost(spark):
    call = lambda model, **x: ("model.call", None, "s", AT, "{" + ", ".join(f'"{k}": {v}' for k, v in {"model_id": f'"{model}"', **x}.items()) + "}")
    rows = [call("a", input_tokens=10, output_tokens=2, cached_input_tokens=4, cache_write_tokens=9, premium_requests=0.33), call("b", input_tokens=5), ("model.call", "run", "s", AT, "{}"), ("model.call", None, None, AT, "{}"), ("model.call", None, "t", AT, None), ("model.call", None, "s", dt.datetime(2023, 1, 1), "{}")]
    e = spark.createDataFrame(rows, "event_type string, run_id string, trace_id string, event_time timestamp, attributes string")
    book = spark.createDataFrame([("a", dt.date(2024, 1, 1), None, 7, 11, 3, False)], "model_id string, effective_from date, effective_to date, p_in long, p_out long, p_cached long, placeholder boolean")
    p = usage.priced(usage.session_calls(e, "2024-01-01"), book)
    got = {(r.session_id, r.model_id): (r.total_tokens, r.priceable, r.cost_nano, r.premium_requests) for r in p.collect()}
    assert got[("s", "a")][:3] == (12, True, 6 * 7 + 2 * 11 + 4 * 3) and float(got[("s", "a")][3]) == 0.33
    assert got[("s", "b")][:3] == (5, False, None) and got[("t", None)][:3] == (None, False, None)
    sums = {r.session_id: (r.model_calls, r.input_tokens, r.cost_nano) for r in usage.by_session(p).collect()}
    assert sums == {"s": (2, 15, None), "t": (1, None, None)}
    assert usage.session_findings(e.limit(0), "2024-01-09").isEmpty()


def test_trailers_labels_and_payloads(spark):
    d = spark.createDataFrame([("x\nAI-Agent: one \n ai-agent : two words\nAI-Agent:", ["copilot x", None, "COPILOT"], '{"b": [1, 2], "a": null}', '{"a": null, "b": [1,2]}'), (None, None, None, "odd")], "m string, l array<string>, j string, k string")
    got = d.select(C.trailer(F.col("m"), "AI-Agent"), C.drifted_labels(F.col("l"), ["COPILOT"], r"COPILOT"), C.canonical_json(F.col("j")) == C.canonical_json(F.col("k"))).collect()
    assert tuple(got[0]) == ("two words", ["COPILOT X"], True) and tuple(got[1]) == (None, [], None)


def test_runs_of_cycles_in_the_window(spark):
    at = lambda d: dt.datetime(2024, 1, d)
    cycles = spark.createDataFrame([("a", at(1), None, None, at(9)), ("b", at(1), at(2), None, None), ("c", None, None, None, None), (None, None, at(9), None, None), ("a", at(9), None, None, None)], "cycle_key string, updated_at timestamp, created_at timestamp, start_at timestamp, end_at timestamp")
    runs = spark.createDataFrame([("a", "Passed", at(3), None), ("a", "not run", at(3), None), ("b", "fail", at(3), None), ("c", "odd", at(3), None), (None, "passed", at(3), None)], "cycle_key string, status string, executed_at timestamp, defects array<string>")
    assert sorted((r.cycle_key, r.status_category) for r in tracker.run_pass(cycles, runs, "2024-01-05").collect()) == [("a", "passed"), ("c", "other")]
    every = tracker.run_pass(cycles, runs, None, include_not_run=True)
    got = {r.cycle_key: (r.executed, r.not_run, r.pass_rate) for r in tracker.test_totals(every, "cycle_key").collect()}
    assert got == {"a": (1, 1, 100.0), "b": (1, 0, 0.0), "c": (0, 0, None)}
    assert tracker.run_pass(cycles.limit(0), runs, None).isEmpty()
