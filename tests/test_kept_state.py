"""State that is kept between runs: versions, marks, the inbox's ledger, the index, the watch, and upkeep."""

import datetime as dt
import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from deliverylens.operators import upkeep, watch
from deliverylens.operators.versions import Appended, Conflict, VersionedTable
from deliverylens.sources import inbox, polling

D = dt.date


def table(spark, tmp_path, name, schema):
    return VersionedTable(spark, str(tmp_path / name), schema)


def test_versions_are_whole_and_one_writer_wins(spark, tmp_path):
    t = table(spark, tmp_path, "t", "k string, n long")
    assert t.version() == 0 and t.read().collect() == []
    for k in range(1, 5):
        assert t.replace(spark.createDataFrame([("a", k)], "k string, n long"), k - 1) == k
    assert [tuple(r) for r in t.read().collect()] == [("a", 4)] and [tuple(r) for r in t.read(3).collect()] == [("a", 3)]
    with pytest.raises(Conflict):
        t.replace(spark.createDataFrame([("b", 0)], "k string, n long"), 3)
    boom = F.udf(lambda k: 1 // 0, "long")
    with pytest.raises(Exception, match="ZeroDivision"):
        t.replace(t.read().withColumn("n", boom("k")), 4)
    assert [tuple(r) for r in t.read().collect()] == [("a", 4)]
    assert not t.folder.put_new("commits/4", "other") and t.folder.read("commits/4") != "other"


def at(h):
    return dt.datetime(2024, 1, 1, h)


def test_a_mark_moves_only_after_a_whole_pass(spark, tmp_path):
    rows = Appended(spark, str(tmp_path / "rows"), "event_id string, updated_at timestamp")
    marks = table(spark, tmp_path, "marks", polling.MARKS)
    source = [("a", at(1)), ("b", at(3)), ("b", at(2))]
    asked = []

    def read(since):
        asked.append(since)
        out = spark.createDataFrame(source, "event_id string, updated_at timestamp")
        return out if since is None else out.where(F.col("updated_at") >= F.lit(since))

    held = lambda: sorted(r.event_id for r in rows.read().collect())
    assert polling.poll(read, "s", rows, marks) == (3, at(3), True) and held() == ["a", "b"]
    source.append(("c", at(5)))
    boom = F.udf(lambda k: 1 // 0 if k == "c" else k, "string")
    with pytest.raises(Exception, match="ZeroDivision"):
        polling.poll(lambda since: read(since).withColumn("event_id", boom("event_id")), "s", rows, marks)
    assert held() == ["a", "b"] and polling.mark_of(marks.read(), "s") == at(3) and marks.version() == 1
    assert polling.poll(read, "s", rows, marks, complete=False) == (2, at(3), False) and held() == ["a", "b", "c"]
    assert polling.poll(read, "s", rows, marks) == (2, at(5), True) and held() == ["a", "b", "c"]
    source[:] = [("d", at(0))]
    assert polling.poll(lambda since: spark.createDataFrame(source, "event_id string, updated_at timestamp"), "s", rows, marks) == (1, at(5), False)
    polling.poll(read, "other", rows, marks)
    assert {(r.source, r.mark, r.runs) for r in marks.read().collect()} == {("s", at(5), 2), ("other", at(0), 1)} and asked[0] is None


def bundle(events, **manifest):
    body = "".join(json.dumps(e) + "\n" for e in events)
    head = {"format": "telemetry-bundle", "schema_version": "1.0.0", "machine_id": "m1", "window_start": "2024-01-01T00:00:00Z", "window_end": "2024-01-02T23:59:59Z", "event_count": len(events), "sha256": hashlib.sha256(body.encode()).hexdigest()}
    return json.dumps({"_manifest": head | manifest}) + "\n" + body


def event(k, person=None, **attributes):
    return {"event_id": f"e{k}", "event_type": "tool.call", "event_time": f"2024-01-0{1 + k % 2}T2{k % 4}:00:00Z", "actor": {"person_id": person}, "attributes": attributes}


def test_importing_an_inbox_twice_changes_nothing(spark, tmp_path):
    box = tmp_path / "inbox"
    box.mkdir()
    (box / "a.ndjson").write_text(bundle([event(1, status="ok"), event(2, "p2", status="ok"), event(3, secret_path="/x")]))
    (box / "b.ndjson").write_text(bundle([event(2, status="error"), event(4, status="ok")], machine_id="m2"))
    (box / "again.ndjson").write_text((box / "b.ndjson").read_text())
    (box / "bad.ndjson").write_text(bundle([event(9)], event_count=5))
    (box / "quiet.ndjson").write_text(bundle([], sources={"repos": False}))
    rows = Appended(spark, str(tmp_path / "rows"), "event_id string, person_id string, attributes string")
    ledger = table(spark, tmp_path, "ledger", inbox.LEDGER)
    who = spark.createDataFrame([("a.ndjson", "p1"), ("again.ndjson", "p3"), ("b.ndjson", " ")], "file string, person_id string")
    run = lambda: inbox.import_inbox(str(box), rows, ledger, {"tool.call": ["status"]}, who)
    got = sorted((r.file, r.events, r.rejected, r.measured, r.fault) for r in run().collect())
    assert got == [("a.ndjson", 2, 1, True, None), ("again.ndjson", 2, 0, True, None), ("bad.ndjson", 0, 0, None, "count_mismatch"), ("quiet.ndjson", 0, 0, False, None)]
    held = lambda: sorted((r.event_id, r.person_id) for r in rows.read().collect())
    first = held()
    assert [e for e, _ in first] == ["e1", "e2", "e4"] and dict(first)["e1"] == "p1" and dict(first)["e4"] == "p3"
    assert run().collect() == [] and held() == first
    (box / "c.ndjson").write_text(bundle([event(4, status="ok"), event(5, status="ok")]))
    assert [(r.file, r.events) for r in run().collect()] == [("c.ndjson", 2)] and [e for e, _ in held()] == ["e1", "e2", "e4", "e5"]
    assert ledger.read().count() == 5
    # a pass that stopped after its events: the ledger is one version back, and nothing doubles
    lost = VersionedTable(spark, str(tmp_path / "ledger2"), inbox.LEDGER)
    inbox.import_inbox(str(box), rows, lost, {"tool.call": ["status"]}, who)
    assert [e for e, _ in held()] == ["e1", "e2", "e4", "e5"]


def test_several_refreshes_equal_one(spark, tmp_path):
    objects = [(f"k{n:02d}", f"p{n % 3}", at(n % 20), bundle([event(n), event(n + 1)], window_start=None if n == 4 else f"2024-01-01T00:00:0{n % 9}Z")) for n in range(11)]
    objects += [("k99", "p0", at(3), "not a bundle"), ("k98", "p0", at(4), bundle([]))]
    store = spark.createDataFrame(objects, "key string, person string, uploaded_at timestamp, value string")
    one, many = (Appended(spark, str(tmp_path / n), inbox.INDEX) for n in ("one", "many"))
    assert inbox.refresh_index(store, one) == 0
    left = [inbox.refresh_index(store, many, 4)]
    assert {r.key for r in many.read().collect()} == {"k10", "k09", "k08", "k07"}  # the latest first
    os.makedirs(tmp_path / "many" / "_torn")  # a refresh that stopped before it was published
    while left[-1]:
        left.append(inbox.refresh_index(store, many, 4))
    assert left == [9, 5, 1, 0]
    many.append(many.read().where("key = 'k03'"))  # two refreshes at once
    got, want = (sorted(map(tuple, inbox.indexed_days(t).collect())) for t in (many, one))
    assert got == want and sum(r[3] for r in got) == 22


def test_silence_is_told_once_for_each_worsening(spark, tmp_path):
    state = table(spark, tmp_path, "state", watch.STATE)
    up = [("Ann ", dt.datetime(2024, 1, 5, 20)), ("bob", dt.datetime(2024, 1, 12, 1)), ("bob", None), (None, dt.datetime(2024, 1, 12, 1)), ("eve", dt.datetime(2024, 1, 14, 3))]
    roster = spark.createDataFrame([("ann",), ("BOB",), ("cy",), ("eve",), (" ",), (None,)], "person string")
    sent = []

    def run(today, objects=up, fail=False):
        def send(rows):
            if fail:
                raise OSError("no line")
            sent.append({r.person: r.missed for r in rows.collect()})

        out = watch.check(spark.createDataFrame(objects, "person string, uploaded_at timestamp"), roster, state, today, send)
        return {r.person: (r.missed, r.settled, r.alerting) for r in out.collect()}

    # 5 January 20:00 UTC is Saturday the 6th at +07:00, no working day: ann misses all days before it too
    first = run(D(2024, 1, 12))
    assert first == {"ann": (10, True, True), "bob": (10, False, False), "cy": (10, False, False), "eve": (10, False, False)} and sent == [{"ann": 10}]
    assert run(D(2024, 1, 12)) == first | {"ann": (10, True, False)} and sent[-1] == {}
    with pytest.raises(OSError):
        run(D(2024, 1, 17), fail=True)
    later = run(D(2024, 1, 17))
    assert later["bob"] == (2, True, False) and later["cy"] == (10, True, True) and later["ann"] == (10, True, False) and later["eve"] == (10, True, True) and sent[-1] == {"cy": 10, "eve": 10}  # a Sunday's upload fills no working day
    back = run(D(2024, 1, 18), [*up, ("ann", dt.datetime(2024, 1, 17, 2))])
    assert back["ann"] == (0, True, False)
    assert {r.person: r.alerted_streak for r in state.read().collect()}["ann"] is None


def fold(events):
    """Counts by day, and how many events the sessions of a day have in all."""
    size = events.groupBy("trace_id").agg(F.count("*").alias("size"))
    return events.join(size, "trace_id").groupBy("day").agg(F.count("*").alias("n"), F.sum("size").alias("reach"))


def files(path):
    return {p: sorted(os.listdir(os.path.join(path, p))) for p in os.listdir(path) if "=" in p}


def test_late_days_are_rebuilt_and_no_others(spark, tmp_path):
    old = [("s1", D(2024, 1, 1)), ("s1", D(2024, 1, 2)), ("s2", D(2024, 1, 2)), ("s2", D(2024, 1, 3)), ("s3", D(2024, 1, 4)), ("s4", D(2024, 1, 5)), ("s4", D(2024, 1, 6))]
    late = [("s1", D(2024, 1, 1)), ("s9", D(2024, 1, 9)), ("s4", D(2024, 1, 6))]
    rows = lambda x: spark.createDataFrame(x, "trace_id string, day date")
    path, whole = str(tmp_path / "mart"), str(tmp_path / "whole")
    fold(rows(old)).write.partitionBy("day").parquet(path)
    before = files(path)
    assert upkeep.rebuild_late(rows(old + late), rows(late), fold, path) == 5
    fold(rows(old + late)).write.partitionBy("day").parquet(whole)
    table_of = lambda p: sorted(map(tuple, spark.read.parquet(p).select("day", "n", "reach").collect()))
    assert table_of(path) == table_of(whole)
    after = files(path)
    assert {d for d in before if after[d] == before[d]} == {"day=2024-01-03", "day=2024-01-04"}


def test_only_covered_old_days_are_pruned(spark, tmp_path):
    path = str(tmp_path / "buffer")
    spark.createDataFrame([(k, D(2024, 1, 1 + k % 4)) for k in range(12)], "k long, day date").write.partitionBy("day").parquet(path)
    receipts = spark.createDataFrame([("2024-01-01", 2), ("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-04", 3)], "day string, n long")
    assert upkeep.prune(path, receipts, "2024-01-04") == ["2024-01-01"]
    assert sorted({str(r.day) for r in spark.read.parquet(path).collect()}) == ["2024-01-02", "2024-01-03", "2024-01-04"]


def test_a_sink_that_fails_loses_no_row(spark, tmp_path):
    src, spill = str(tmp_path / "src"), str(tmp_path / "spill")
    spark.range(5).write.json(src)
    got, broken = [], [True]

    def send(rows):
        if broken[0]:
            raise OSError("no line")
        got.extend(r.id for r in rows.collect())

    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).json(src)
    stream.writeStream.foreachBatch(upkeep.deliver(send, spill)).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert not got and upkeep.resend(spark, send, spill) == 0
    broken[0] = False
    assert upkeep.resend(spark, send, spill) >= 1 and sorted(got) == list(range(5)) and upkeep.resend(spark, send, spill) == 0


def test_a_day_of_findings_is_replaced(spark, tmp_path):
    path = str(tmp_path / "findings")
    schema = "detected_date string, check string, subject string, severity string, n int, value string"
    upkeep.write_findings(spark.createDataFrame([("2024-01-01", "DQ-1", "p", "high", 1, "x@y.z"), ("2024-01-02", "DQ-2", "q", "low", 2, "v")], schema), path)
    upkeep.write_findings(spark.createDataFrame([("2024-01-02", "DQ-3", "r", "low", 3, "v")], schema), path)
    rows = spark.read.json(path).collect()
    assert sorted((str(r.detected_date), r.check, r.n) for r in rows) == [("2024-01-01", "DQ-1", 1), ("2024-01-02", "DQ-3", 3)] and "value" not in rows[0]
