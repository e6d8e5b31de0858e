"""Queries that once left rows out: their whole job on the stored tables."""

import datetime as dt
from collections import defaultdict

from deliverylens.operators import rule_queries, state_queries, temporal
from tests.conftest import DATA

SF = f"{DATA}/sf0.01"


def _runs(spark):
    return {r.run_id: r for r in state_queries._runs(state_queries._events(spark, SF)).collect()}


def test_every_run_has_a_window(spark):
    got = {r.run_id for r in state_queries.x07_run_window(spark, SF).collect()}
    assert got == set(_runs(spark)) and len(got) == 1886
    assert "2024-01-25" not in state_queries.ORACLE_SQL["x07_run_window"]


def test_calls_of_all_days_are_bound(spark):
    got = {r.span_id: r.run_id for r in state_queries.j05_span_binding(spark, SF).collect()}
    days = {run.split("_")[2] for run in got.values()}
    assert days == {r.started_at.strftime("%Y%m%d") for r in _runs(spark).values() if r.run_id in set(got.values())} and max(days) > "20240125"
    assert "2024-01-25" not in state_queries.ORACLE_SQL["j05_span_binding"]


def test_all_overlapping_runs_are_paired(spark):
    runs = _runs(spark).values()
    mine = defaultdict(list)
    for r in runs:
        mine[r.user_id].append(r)
    till = lambda r: r.ended_at or r.started_at + dt.timedelta(hours=24)
    pairs = {(a.run_id, b.run_id) for b in runs for a in mine[b.user_id] if a.started_at < b.started_at <= till(a)}
    assert any(a.split("_")[2] != b.split("_")[2] for a, b in pairs)
    got = [(r.first_run, r.second_run) for r in rule_queries.j14_overlapping_intervals(spark, SF).collect()]
    assert sorted(x for x in got if x[0]) == sorted(pairs) and {b for _, b in got} == {r.run_id for r in runs}


def test_rows_open_before(spark):
    at = lambda d, h: dt.datetime(2024, 1, d, h)
    rows = [("a", 1, at(1, 1), at(3, 5)), ("a", 2, at(2, 1), at(2, 2)), ("a", 3, at(2, 1), at(2, 0)), ("a", 4, at(3, 5), None), ("a", 5, at(4, 1), at(4, 2)), (None, 6, at(2, 1), at(2, 2)), ("b", 7, None, at(2, 2))]
    df = spark.createDataFrame(rows, "k string, n int, lo timestamp_ntz, hi timestamp_ntz")
    got = sorted((r.n, r.open_before or 0) for r in temporal.open_before(df, "n", "k", "lo", "hi").collect())
    assert got == [(1, 0), (2, 1), (3, 1), (4, 1), (5, 0), (6, 0), (7, 0)]
    assert temporal.open_before(df.limit(0), "n", "k", "lo", "hi").count() == 0
