"""Which run a session or a call belongs to: explicit evidence first, then windows that hold it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values of the binding rules, in seconds.
SLACK_S, OPEN_RUN_S = 90, 3_600
GRACE_S, LONGEST_RUN_S = 300, 24 * 3_600


def _later(at: Column, seconds: int) -> Column:
    return at + F.make_dt_interval(secs=F.lit(seconds))


def held_by(points: DataFrame, windows: DataFrame, key: str, at: str, lo: str, hi: str, till: str | None = None, how: str = "inner") -> DataFrame:
    """points joined with the windows of their key that hold ``at`` (and ``till``), both ends included.

    A window stands once for each day that it touches and a point has one day, so a
    pair meets once, and a key with many rows meets only those of its day.
    """
    day = lambda c: F.to_date(c)
    w = windows.withColumn("_day", F.explode(F.sequence(day(lo), day(hi)))).withColumnRenamed(key, "_key")
    fits = (points[key] == w["_key"]) & (day(points[at]) == w["_day"]) & (points[at] >= w[lo])
    fits = fits & ((points[till] if till else points[at]) <= w[hi])
    return points.join(w, fits, how).drop("_key", "_day")


def run_windows(runs: DataFrame, cutover: dt.date | None = None) -> DataFrame:
    """runs (run_id, session, started_at, ended_at) with bind_from and bind_to: five minutes on
    either side, an open run for 24 hours; runs from a cutover on and runs without a session have none."""
    end = F.coalesce("ended_at", _later(F.col("started_at"), LONGEST_RUN_S))
    ok = runs.where("session IS NOT NULL AND started_at IS NOT NULL")
    if cutover is not None:
        ok = ok.where(F.col("started_at") < F.lit(cutover).cast("timestamp_ntz"))
    return ok.withColumns({"bind_from": _later(F.col("started_at"), -GRACE_S), "bind_to": _later(end, GRACE_S)})


def bind_spans(spans: DataFrame, windows: DataFrame) -> DataFrame:
    """spans (span_id, session, start_time) with the run of their session whose window holds them.

    Of several the one that started last takes the span, then the smaller id, so that no
    span counts twice. Spans without a run are left out.
    """
    met = held_by(spans, windows.select("run_id", "session", "started_at", "bind_from", "bind_to"), "session", "start_time", "bind_from", "bind_to")
    nth = F.row_number().over(Window.partitionBy("span_id").orderBy(F.desc("started_at"), "run_id"))
    return met.withColumn("_nth", nth).where("_nth = 1").select(*spans.columns, "run_id")


def shared_sessions(runs: DataFrame, now: dt.datetime, over: int = 20) -> DataFrame:
    """(session, day, runs) of sessions that more than ``over`` runs of the last two days share in a day."""
    recent = runs.where(F.col("session").isNotNull() & (F.col("started_at") >= F.lit(now - dt.timedelta(days=2)).cast("timestamp_ntz")))
    return recent.groupBy("session", F.to_date("started_at").alias("day")).agg(F.count("*").alias("runs")).where(F.col("runs") > over)


def link_sessions(sessions: DataFrame, runs: DataFrame, bound: DataFrame, key: str) -> DataFrame:
    """(session, run_id, method, confidence, outcome) of every session.

    sessions: session, key, agents (array), t0, t1. runs: run_id, key, agent, started_at, ended_at.
    bound: run_id, session. A session that a run names is its own, surely (1.0; of several runs the smaller id).
    Else the only run of its key whose window holds it whole: 90 seconds before its start
    to 90 seconds after its end, or to an hour after its start while it is open; 0.8 if the run's
    agent is one of the session's, else 0.5. No run, or several, leave it unlinked, and the outcome says which.
    """
    told = bound.join(runs.select("run_id"), "run_id", "left_semi").groupBy("session").agg(F.min("run_id").alias("_told"))
    s = sessions.join(told, "session", "left")
    finish = F.coalesce(_later(F.col("ended_at"), SLACK_S), _later(F.col("started_at"), OPEN_RUN_S))
    w = runs.select(key, "run_id", F.col("agent").alias("run_agent"), _later(F.col("started_at"), -SLACK_S).alias("_a"), finish.alias("_b")).where("_a <= _b")
    met = held_by(s.where("_told IS NULL").withColumn("_end", F.coalesce("t1", "t0")), w, key, "t0", "_a", "_b", "_end", "left")
    n, agrees = F.count("run_id"), F.coalesce(F.bool_or(F.array_contains("agents", F.col("run_agent"))), F.lit(False))
    found = met.groupBy("session").agg(
        F.when(n == 1, F.min("run_id")).alias("run_id"), F.when(n == 1, "heuristic").alias("method"), F.when(n == 1, F.when(agrees, 0.8).otherwise(0.5)).alias("confidence"),
        F.when(n == 0, "no_run").when(n > 1, "several_runs").otherwise("linked").alias("outcome"),
    )
    sure = s.where("_told IS NOT NULL").select("session", F.col("_told").alias("run_id"), F.lit("explicit").alias("method"), F.lit(1.0).alias("confidence"), F.lit("linked").alias("outcome"))
    return sure.unionByName(found)
