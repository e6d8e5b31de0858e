"""Plans against DuckDB, and operators on literal rows."""

import json
import os
from datetime import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from deliverylens.functions import columns as C
from deliverylens.operators import dedup, ingest, journal, store, temporal
from deliverylens.plans import catalogue
from deliverylens.sources import events as src
from deliverylens.streaming import ingest as stream
from tests.conftest import DATA


def same(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in catalogue.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/sf0.001/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.PLANS))
def test_plan_equals_its_sql(spark, con, name):
    got = catalogue.queries()[name](spark, f"{DATA}/sf0.001")
    rel = con.execute(catalogue.oracle_sql()[name])
    cols = [x[0] for x in rel.description]
    assert sorted(got.columns) == sorted(cols)
    order = sorted(cols)
    a = sorted(tuple(same(r[c]) for c in order) for r in got.collect())
    b = sorted(tuple(same(r[cols.index(c)]) for c in order) for r in rel.fetchall())
    assert a == b


def event(i, t="2026-08-03T10:00:00Z", kind="tool.call", **more):
    return {"schema_version": "1.1.0", "event_id": f"e{i}", "event_type": kind, "event_time": t, "trace_id": "s1", "run_id": None, "actor": {"person_id": "p"}, "attributes": {}, "link": {"method": "explicit", "confidence": 1.0}} | more


def test_ndjson_folder_and_its_stats(spark, tmp_path):
    os.makedirs(tmp_path / "deep")
    rows = [json.dumps(event(1)), json.dumps(event(1, "2026-08-03T11:00:00+0200")), "{not json", json.dumps({"event_id": "x"}), json.dumps(event(2, "soon")), "", "[1]"]
    (tmp_path / "deep" / "a.ndjson").write_text("\n".join(rows))
    (tmp_path / "b.txt").write_text("{}")
    s = src.load_stats(spark, str(tmp_path)).first().asDict()
    assert s == {"files": 1, "lines": 6, "malformed": 2, "no_type": 1, "no_timestamp": 1, "duplicates": 1}
    got = src.read_events(spark, str(tmp_path)).collect()
    assert [(r.event_id, r.event_time.isoformat()) for r in got] == [("e1", "2026-08-03T09:00:00")]
    assert src.read_events(spark, str(tmp_path), need_time=False).count() == 2


def test_ingest_rejects_strips_and_clamps(spark):
    cases = [
        (event(1, attributes={"input_tokens": 5, "note": "fine"}), None, []),
        (event(2, attributes={"a": [{"Message": "x"}]}), "forbidden:message", []),
        (event(3, attributes={"v": "password: hunter22"}), "secret:password_assignment", []),
        (event(4, kind="other"), "event_type", []),
        (event(5, schema_version="2.0.0"), "schema_version", []),
        (event(6, trace_id=""), "missing:trace_id", []),
        (event(7, "2031-01-01T00:00:00Z"), None, ["DQ-10:event_time"]),
        (event(8, agent={"surface": "toaster"}), None, ["DQ-15:surface"]),
        (event(9, attributes={"tool_name": "x", "weird": 1}), None, ["stripped:weird"]),
    ]
    df = spark.createDataFrame([(json.dumps(e),) for e, _, _ in cases], "value string")
    got = {r.event_id: r for r in ingest.admit(src.flat(src.parsed(df)), "2026-08-04 00:00:00", {"tool.call": ["tool_name", "input_tokens", "note", "v", "a"]}).collect()}
    for e, reject, flags in cases:
        assert (got[e["event_id"]].reject, got[e["event_id"]].dq_flags) == (reject, flags)
    assert got["e7"].event_time == datetime(2026, 8, 4) and got["e8"].surface is None and json.loads(got["e9"].attributes) == {"tool_name": "x"}


def test_stream_equals_batch(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    for k in range(3):
        (tmp_path / "in" / f"{k}.ndjson").write_text("\n".join(json.dumps(event(i, kind="human.turn" if i % 2 else "tool.call")) for i in range(k * 5, k * 5 + 8)))
    q = stream.run_once(stream.event_stream(spark, str(tmp_path / "in"), "2026-08-04 00:00:00", max_files=1), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert q.exception() is None
    batch = dedup.keep_first(stream.accepted(src.lines(spark, str(tmp_path / "in")), "2026-08-04 00:00:00"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.event_id for r in got.collect()) == sorted(r.event_id for r in batch.collect()) and got.count() == 18
    stream.run_once(stream.event_stream(spark, str(tmp_path / "in"), "2026-08-04 00:00:00"), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 18  # nothing new: nothing twice
    assert {(str(r.week), r.n) for r in stream.weekly_counts(batch).groupBy("week").agg(F.sum("n").alias("n")).collect()} == {("2026-08-03", 18)}


def test_bundles_are_checked(spark, tmp_path):
    import hashlib

    body = json.dumps(event(1)) + "\n" + json.dumps(event(2))
    good = {"format": "telemetry-bundle", "schema_version": "1.1.0", "event_count": 2, "sha256": hashlib.sha256(body.encode()).hexdigest()}
    for name, m in {"good": good, "wrong_format": good | {"format": "x"}, "wrong_major": good | {"schema_version": "2.0.0"}, "count_mismatch": good | {"event_count": 3}, "checksum_mismatch": good | {"sha256": "0"}}.items():
        (tmp_path / f"{name}.ndjson").write_text(json.dumps({"_manifest": m}) + "\n" + body)
    (tmp_path / "not_a_manifest.ndjson").write_text(body)
    manifests, events_ = src.read_bundles(spark, str(tmp_path))
    got = {r.file.rsplit("/", 1)[1].removesuffix(".ndjson"): r.fault for r in manifests.collect()}
    assert got.pop("good") is None and all(k == v for k, v in got.items()) and len(got) == 5
    assert events_.count() == 2


def test_bodies_and_sheets(spark, tmp_path):
    bodies = [json.dumps([event(1), event(2)]), json.dumps(event(3)), json.dumps(event(4)) + "\n" + json.dumps(event(5))]
    got = src.body_events(spark.createDataFrame([(b,) for b in bodies], "body string"))
    assert sorted(r.id for r in got.select(F.col("e.event_id").alias("id")).collect()) == ["e1", "e2", "e3", "e4", "e5"]
    (tmp_path / "a.tsv").write_text("# who\nx@y\t2026-08-03\tin\t08:30\n\nz@y\t2026-08-03\toff")
    assert [tuple(r) for r in src.read_tsv(spark, str(tmp_path / "a.tsv"), ["email", "date", "state", "at"]).collect()] == [("x@y", "2026-08-03", "in", "08:30"), ("z@y", "2026-08-03", "off", None)]


def test_table_maintenance(spark, tmp_path):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (None, "n", 1)], "k int, s string, at int")
    new = spark.createDataFrame([(1, "a", 9), (2, "c", 9), (3, "d", 9)], "k int, s string, at int")
    assert sorted(map(str, map(tuple, store.upsert(old, new, ["k"]).collect()))) == sorted(map(str, [(1, "a", 9), (2, "c", 9), (3, "d", 9), (None, "n", 1)]))
    assert sorted(map(str, map(tuple, store.upsert_on_change(old, new, ["k"], "s", "at").collect()))) == sorted(map(str, [(1, "a", 1), (2, "c", 9), (3, "d", 9), (None, "n", 1)]))
    assert [tuple(r) for r in store.append_new(old.select(F.col("k").alias("event_id")), new.select(F.col("k").alias("event_id"))).collect()] == [(3,)]
    p = str(tmp_path / "t")
    store.write_window(spark.createDataFrame([("d1", 1), ("d2", 2)], "day string, v int"), p)
    store.write_window(spark.createDataFrame([("d0", 0), ("d3", 9)], "day string, v int"), p)
    store.write_window(spark.createDataFrame([("d2", 5)], "day string, v int"), p, since="d1x")
    assert sorted((r.day, r.v) for r in spark.read.parquet(p).collect()) == [("d0", 0), ("d1", 1), ("d2", 5)]
    book = spark.sql("SELECT 'm' model_id, date'2024-01-01' effective_from, CAST(NULL AS date) effective_to, 1.5D p_in")
    changed = store.set_price(book, "m", "2024-03-01", {"p_in": 2.0})
    assert [(str(r.effective_from), str(r.effective_to), r.p_in) for r in changed.orderBy("effective_from").collect()] == [("2024-01-01", "2024-02-29", 1.5), ("2024-03-01", "None", 2.0)]
    assert store.set_price(book, "m", "2023-01-01", {"p_in": 2.0}).count() == 1
    assert store.expire(spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-01-31')) d"), "d", "2024-01-31", 10).count() == 11


def test_joins_on_time(spark):
    facts = spark.sql("SELECT * FROM VALUES ('m', date'2024-01-10'), ('m', date'2024-01-20'), ('x', date'2024-01-10') AS t(model_id, day)")
    book = spark.sql("SELECT * FROM VALUES ('m', date'2024-01-01', date'2024-01-15', 1), ('m', date'2024-01-16', null, 2) AS t(model_id, effective_from, effective_to, p)")
    assert sorted(str((r.model_id, r.day.day, r.p)) for r in temporal.effective(facts, book, "model_id", "day").collect()) == sorted(map(str, [("m", 10, 1), ("m", 20, 2), ("x", 10, None)]))
    left = spark.sql("SELECT * FROM VALUES ('a', 5, 0), ('a', 1, 0), ('a', 9, 8) AS t(k, at, lo)")
    right = spark.sql("SELECT * FROM VALUES ('a', 3, 'x'), ('a', 5, 'y'), ('b', 1, 'z') AS t(k, at, v)")
    assert sorted(str((r["at"], r.v)) for r in temporal.as_of(left, right, ["k"], "at", "v", "lo").collect()) == sorted(map(str, [(5, "y"), (1, None), (9, None)]))
    runs = spark.sql("SELECT * FROM VALUES ('r1', 'p', 'g', timestamp'2024-01-01 10:00:00', timestamp'2024-01-01 11:00:00'), ('r2', 'p', 'g', timestamp'2024-01-01 10:30:00', null) AS t(run_id, person, agent, started_at, ended_at)")
    ses = spark.sql("SELECT * FROM VALUES ('s1', 'p', 'g', timestamp'2024-01-01 10:05:00', timestamp'2024-01-01 10:06:00'), ('s2', 'p', 'g', timestamp'2024-01-01 10:35:00', timestamp'2024-01-01 10:36:00'), ('s3', 'q', 'g', timestamp'2024-01-01 10:35:00', timestamp'2024-01-01 10:36:00'), ('s4', 'p', 'h', timestamp'2024-01-01 11:10:00', timestamp'2024-01-01 11:20:00') AS t(session_id, person, agent, t0, t1)")
    got = {r.session_id: (r.run_id, r.confidence, r.outcome) for r in temporal.interval_link(ses, runs, "person").collect()}
    assert got == {"s1": ("r1", 0.8, "linked"), "s2": (None, 0.0, "several_runs"), "s3": (None, 0.0, "no_run"), "s4": ("r2", 0.5, "linked")}


def test_rows_that_start_while_another_is_open(spark):
    rows = [("a", 1, 5), ("a", 5, 6), ("a", 5, 9), ("a", 7, 7), ("a", 10, None), ("a", 11, 12), ("b", 2, 3), ("b", 2, 8), ("b", 9, 9), (None, 1, 9), ("b", None, 1)]
    df = spark.createDataFrame(rows, "k string, lo int, hi int")
    got = {(r.k, r.lo): (r.n, r.overlapped) for r in temporal.overlapped(df, "k", "lo", "hi").collect()}
    assert got == {("a", 1): (1, False), ("a", 5): (2, True), ("a", 7): (1, True), ("a", 10): (1, False), ("a", 11): (1, True), ("b", 2): (2, False), ("b", 9): (1, False)}
    assert temporal.overlapped(df.limit(0), "k", "lo", "hi").count() == 0


def test_journal_folds(spark):
    rows = spark.sql("SELECT * FROM VALUES ('s', 1, 'r1', null), ('s', 2, null, 'x'), ('s', 3, 'r2', null) AS t(session_id, n, run, skill)")
    got = journal.running_state(rows, "session_id", ["n"], ["run", "skill"]).orderBy("n").collect()
    assert [(r.current_run, r.current_skill) for r in got] == [("r1", None), ("r1", "x"), ("r2", "x")]
    calls = spark.sql("SELECT * FROM VALUES ('s', 'c1', 'start', timestamp'2024-01-01 00:00:00', null), ('s', 'c1', 'complete', timestamp'2024-01-01 00:00:02', 'ok'), ('s', 'c2', 'start', timestamp'2024-01-01 00:00:00', null) AS t(session_id, call, kind, at, status)")
    assert {r.call: (r.duration_ms, r.status) for r in journal.call_pairs(calls, "call", "at").collect()} == {"c1": (2000, "ok"), "c2": (None, None)}
    gates = spark.sql("SELECT * FROM VALUES ('g', 1, 'fail'), ('g', 2, 'pass'), ('g', 3, 'fail'), ('g', 4, 'pass') AS t(g, n, st)")
    assert [r.n for r in journal.first_fix(gates, ["g"], ["n"], "st", "fail", "pass").collect()] == [2]


def test_column_helpers(spark):
    one = spark.range(1)

    def value(c):
        return one.select(c.alias("v")).first().v

    lit = F.lit
    assert value(C.issue_key([lit(None), lit("IML-TC-5 blocks IML-6500")], ["IML"])) == "IML-6500"
    assert value(C.issue_key([lit("fix/AUG-25")], ["IML"])) is None and value(C.issue_key([lit("IML-1")], [])) is None
    assert value(C.has_marker(lit("feat [AI] x\nAI"))) and not value(C.has_marker(lit("mAIn\nAI")))
    assert value(C.model_name(lit("route/abc-4-5"))) == "abc-4.5"
    assert value(C.program(lit("git status"))) == "git" and value(C.program(lit("/bin/sh x"))) is None
    assert value(C.email_hash(lit(" A@b.c "), "s")) == value(C.email_hash(lit("a@b.c"), "s")) and value(C.email_hash(lit("a@b.c"), None)) is None
    assert value(C.iso_week(lit("2026-12-31").cast("date"))) == "2026-W53"
    few = spark.createDataFrame([("a", x) for x in (4, 1, 3, 2, None)] + [("b", 7)], "g string, v int")
    assert {r.g: r.m for r in C.nearest_rank(few, ["g"], "v", 0.5, "m").collect()} == {"a": 3, "b": 7}  # rank 1.5 goes to the even 2
    assert value(C.price(lit(1000), lit(100), lit(400), lit(1.0), lit(2.0), lit(None).cast("double"))) is None
    assert abs(value(C.price(lit(1000), lit(100), lit(400), lit(1.0), lit(2.0), lit(0.5))) - (0.6 + 0.2 + 0.2)) < 1e-12
    g = spark.sql("SELECT * FROM VALUES ('a', 1, true, null), ('a', 2, false, null), ('b', 3, true, 'ok') AS t(g, v, known, st)")
    got = {r.g: (r.s, r.c, r.u) for r in g.groupBy("g").agg(C.sum_if_all(F.col("v"), F.col("known")).alias("s"), C.count_known(F.col("st"), F.col("st") == "ok").alias("c"), C.unanimous(F.col("st")).alias("u")).collect()}
    assert got == {"a": (None, None, None), "b": (3, 1, "ok")}
    assert value(C.epoch(lit(1700000000))) == value(C.epoch(lit(1700000000000)))
