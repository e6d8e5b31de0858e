"""What large tables showed: joins on made keys, and work done once."""

import hashlib
import json
import os
import shutil
from types import SimpleNamespace

import duckdb

from deliverylens.operators import identities
from deliverylens.operators.versions import Appended, VersionedTable
from deliverylens.plans import catalogue
from deliverylens.sources import inbox
from deliverylens.sources.events import bundle_files
from deliverylens.streaming.sessions import JournalFold
from tests.conftest import DATA


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_names_meet_by_shuffled_keys(spark):
    rows = [(f"{n:014d}"[::-1] + "abcdefgh"[: n % 9], f"{n}@x.y") for n in range(400)]
    near = identities.near_names(identities.authors(spark.createDataFrame(rows, "name string, email string")))
    plan = _plan(near)
    assert "BroadcastHashJoin" not in plan and plan.count("SortMergeJoin [key#") >= 2


def test_left_overs_and_places_are_whole(spark):
    names = spark.createDataFrame([("abcd",), ("abcdefghijklmnopq",)], "s string")
    keys = {}
    for r in identities._left_overs(names, "a").collect():
        keys.setdefault(r.a, []).append(r.key)
    for s, got in keys.items():
        left = {s[:i] + s[i + 1 : j] + s[j + 1 :] for i in range(len(s) + 1) for j in range(i, len(s) + 1) if j > i or i == len(s)}
        assert len(got) == 1 + len(s) + len(s) * (len(s) - 1) // 2 and len(set(got)) == len(left)
    long = names.where("length(s) > 14")
    edits = spark.createDataFrame([("abcdefghijklmnopq"[:k] + more + "abcdefghijklmnopq"[k + less :],) for k in range(16) for more, less in (("xy", 2), ("xy", 0), ("", 2), ("x", 0))], "s string")
    met = identities._places(long, "a", 0, 0).join(identities._places(edits.where("length(s) >= 17"), "b", 2, 2), "key")
    assert met.select("b").distinct().count() == edits.where("length(s) >= 17").distinct().count()


def test_inbox_is_read_once(spark, tmp_path):
    box, values = str(tmp_path / "box"), []
    for n in range(40):
        body = json.dumps({"event_id": f"e{n}", "event_type": "tool.call", "attributes": {"status": "é"}}, ensure_ascii=False) + "\n"
        head = {"_manifest": {"format": "telemetry-bundle", "schema_version": "1.0.0", "machine_id": f"m{n % 3}", "event_count": 1, "sha256": hashlib.sha256(body.encode()).hexdigest()}}
        values.append((f"b{n}.ndjson", json.dumps(head) + "\n" + body))
    assert inbox.put_bundles(spark.createDataFrame(values, "name string, value string").repartition(3), f"file:{box}", 4) == 40
    found = bundle_files(spark, box)
    assert "struct<content:binary>" in found._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.file.split("/")[-1], r.digest, r.fault) for r in found.collect()) == sorted((f, hashlib.sha256(v.encode()).hexdigest(), None) for f, v in values)
    table = Appended(spark, f"file:{tmp_path}/table", "event_id string, event_type string, person_id string")
    ledger = VersionedTable(spark, f"file:{tmp_path}/ledger", inbox.LEDGER)
    append = table.append
    table.append = lambda df: (append(df), shutil.rmtree(box))  # the inbox goes before the ledger is written
    told = inbox.import_inbox(box, table, ledger, {"tool.call": ["status"]}, spark.createDataFrame([], "file string, person_id string"))
    assert told.count() == 40 and table.read().count() == 40 and ledger.read().agg({"events": "sum"}).first()[0] == 40
    assert not [n for n in table.folder.names() if n.startswith("_read")]


def test_cost_per_accepted_reads_claims_once_and_keeps_nothing(spark, tmp_path):
    con, sf = duckdb.connect(), f"{DATA}/sf0.001"
    more = {
        "lineitem": "SELECT * FROM t WHERE l_partkey % 7 = 0 UNION ALL SELECT * REPLACE (l_suppkey + 1 AS l_suppkey) FROM t WHERE l_partkey % 5 = 0 UNION ALL SELECT * REPLACE (NULL::INT AS l_linenumber) FROM t WHERE l_partkey % 13 = 0",
        "orders": "SELECT * REPLACE (o_orderdate + INTERVAL 3 DAY AS o_orderdate) FROM t WHERE o_orderkey % 6 = 0",
        "events": "SELECT * REPLACE (ts + INTERVAL 5 HOUR AS ts, 'purchase' AS event_type) FROM t WHERE event_id % 4 = 0",
    }
    for t in os.listdir(sf):
        name = t.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS WITH t AS (SELECT * FROM '{sf}/{t}') SELECT * FROM t UNION ALL {more[name]}" if name in more else f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{t}'")
        con.execute(f"COPY {name} TO '{tmp_path}/{t}'")
    got = catalogue.queries()["m03_cost_per_accepted"](spark, str(tmp_path))
    want = con.execute(catalogue.oracle_sql()["m03_cost_per_accepted"])
    near = lambda rows: sorted([tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows], key=str)
    assert got.columns == [c[0] for c in want.description] and near(tuple(r) for r in got.collect()) == near(want.fetchall())
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "InMemoryRelation" not in plan and plan.count("l_shipdate") and plan.count("RepartitionByExpression [l_orderkey") == 1


class _Store(dict):
    """A state of one session that counts how often it is asked; a value lies at None."""

    asked = 0

    def __getattribute__(self, name):
        if name in ("getValue", "containsKey", "updateValue", "removeKey", "iterator", "clear"):
            _Store.asked += 1
        return super().__getattribute__(name)

    getValue, containsKey, updateValue, removeKey = dict.__getitem__, dict.__contains__, dict.__setitem__, dict.__delitem__
    iterator = lambda self: iter(list(self.items()))
    exists, get, update = (lambda self: None in self), (lambda self: self[None]), (lambda self, v: self.__setitem__(None, v))


def test_the_store_is_asked_for_what_lasts_only():
    stores = {}
    make = lambda name, *_: stores.setdefault(name, _Store())
    fold = JournalFold()
    fold.init(SimpleNamespace(getValueState=make, getMapState=make, listTimers=list, registerTimer=lambda at: None, deleteTimer=lambda at: None))
    names = ("record_id", "call", "own_run", "name", "parent", "tool", "server", "gate", "path", "skill", "repo", "branch", "host", "roots", "base", "head", "human", "body")
    row = lambda at, kind, **more: SimpleNamespace(session_id="s", at_us=at, kind=kind, **(dict.fromkeys(names) | {"record_id": f"r{at:05d}"} | more))
    take = lambda rows: [(r.kind, r.run, r.tool, r.attempt) for r in fold.handleInputRows(("s",), rows, None)]
    rows = [row(0, "session.start", own_run="R", branch="b", repo="o", base="x", head="y")]
    for n in range(500):
        rows += [row(2 * n + 1, "tool.execution_start", call=f"c{n}", tool="bash", gate="test"), row(2 * n + 2, "tool.execution_complete", call=f"c{n}")]
    got = take([*rows, row(2000, "tool.execution_start", call="open", tool="edit", gate="test")])
    assert got[1:] == [("tool.execution_complete", "R", "bash", n) for n in range(500)]
    assert _Store.asked <= 3 and {k: len(v) for k, v in stores.items()} == {"session": 1, "calls": 1, "subs": 0, "gates": 1, "ranges": 1}
    assert take([row(3000, "tool.execution_complete", call="open"), row(3001, "session.shutdown")]) == [("tool.execution_complete", "R", "edit", 500), ("session.shutdown", "R", None, None), ("run.bound", None, None, None)]
    assert not stores["calls"] and stores["gates"] == {("test",): (501,)}


def test_names_near_each_other_are_compared_once(spark, tmp_path):
    base = [f"Supplier#{n:09d}" for n in range(0, 400, 3)] + ["", "a", "b", "ab", "xyz", "Supplier#00000012", "x" * 41] + ["q" * k + "abcdefghij" * 4 + "r" * (5 - k) for k in range(6)]
    base += [("abcdefghij" * 5)[:k] + "-" + ("abcdefghij" * 5)[k + 1 :] for k in range(0, 50, 4)] + [("abcdefghij" * 5)[:k] + "+" + ("abcdefghij" * 5)[k:49] for k in range(0, 50, 6)]
    rows = [(n, name, n % 3 if n % 17 else None) for n, name in enumerate(base * 2 + [None] * 3 + base[:40])] + [(5, "Supplier#000000001", 2), (5, "Supplier#000000004", 2), (None, "Supplier#000000004", 2)]
    spark.createDataFrame(rows, "s_suppkey long, s_name string, s_nationkey int").coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    shutil.copy(f"{DATA}/sf0.001/nation.parquet", tmp_path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW supplier AS SELECT * FROM '{tmp_path}/supplier.parquet/*.parquet'")
    got = catalogue.queries()["f49_name_collisions"](spark, str(tmp_path))
    want = con.execute(catalogue.oracle_sql()["f49_name_collisions"]).fetchall()
    assert sorted(tuple(r) for r in got.collect()) == sorted(want) and len(want) > 3000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin [nation" in plan
