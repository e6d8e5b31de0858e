"""Joins on time: effective-dated, as-of and interval containment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def effective(facts: DataFrame, book: DataFrame, key: str, on: str, start: str = "effective_from", end: str = "effective_to") -> DataFrame:
    """Each fact with the book's row of its date, both ends included; nulls where none fits.

    The key is an equality, so either side's size decides between a broadcast
    and a shuffle; the dates are a residual condition.
    """
    b = book.withColumnsRenamed({key: "_key"})
    fits = (facts[key] == b["_key"]) & facts[on].between(b[start], F.coalesce(b[end], F.lit("9999-12-31").cast("date")))
    return facts.join(b, fits, "left").drop("_key")


def as_of(left: DataFrame, right: DataFrame, keys: list[str], at: str, value: str, floor: str | None = None) -> DataFrame:
    """left with the last ``value`` of right at or before ``at``: one sort of both sides together.

    With ``floor`` (a column of left) values from before it are no match.
    """
    both = left.select(*keys, at, F.lit(1).alias("_side"), F.struct(*left.columns).alias("_row"), F.lit(None).cast(right.schema[value].dataType).alias("_v"), F.lit(None).cast(right.schema[at].dataType).alias("_t"))
    both = both.unionByName(right.select(*keys, at, F.lit(0).alias("_side"), F.lit(None).cast(both.schema["_row"].dataType).alias("_row"), F.col(value).alias("_v"), F.col(at).alias("_t")))
    w = Window.partitionBy(*keys).orderBy(at, "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = both.select("_side", "_row", F.last(F.when(F.col("_side") == 0, F.struct("_v", "_t")), True).over(w).alias("_p")).where("_side = 1")
    ok = F.lit(True) if floor is None else F.col("_p._t") >= F.col(f"_row.{floor}")
    return seen.select("_row.*", F.when(ok, F.col("_p._v")).alias(value))


def interval_link(sessions: DataFrame, runs: DataFrame, key: str, slack_s: int = 90, open_s: int = 3600) -> DataFrame:
    """(session_id, run_id, confidence, outcome): a session goes to the only run that holds it.

    sessions: session_id, key, agent, t0, t1. runs: run_id, key, agent, started_at, ended_at.
    """
    slack = F.make_dt_interval(secs=F.lit(slack_s))
    r = runs.select(F.col(key).alias("_key"), "run_id", F.col("agent").alias("run_agent"), (F.col("started_at") - slack).alias("_a"), (F.coalesce("ended_at", F.col("started_at") + F.make_dt_interval(secs=F.lit(open_s))) + slack).alias("_b"))
    met = sessions.join(r, (sessions[key] == r["_key"]) & (sessions["t0"] >= r["_a"]) & (sessions["t1"] <= r["_b"]), "left")
    n = F.count("run_id")
    agree = F.max(F.col("agent") == F.col("run_agent"))
    return met.groupBy("session_id").agg(
        F.when(n == 1, F.min("run_id")).alias("run_id"),
        F.when(n == 1, F.when(agree, 0.8).otherwise(0.5)).otherwise(0.0).alias("confidence"),
        F.when(n == 0, "no_run").when(n > 1, "several_runs").otherwise("linked").alias("outcome"),
    )


def overlapped(rows: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """(key, start, n, overlapped): whether a row of the key that starts before is open at ``start``.

    An end counts as within, a null end as never. Rows without a key or a start
    are left out; rows of one start count once and don't overlap each other.
    No pairs are made: starts are summed up first, and the greatest end so far
    runs along each key.
    """
    open_end = F.bool_or(F.col(end).isNull())
    starts = rows.where(F.col(key).isNotNull() & F.col(start).isNotNull()).groupBy(key, start).agg(F.count("*").alias("n"), F.max(end).alias("_end"), open_end.alias("_open"))
    before = Window.partitionBy(key).orderBy(start).rowsBetween(Window.unboundedPreceding, -1)
    over = F.max("_open").over(before) | (F.max("_end").over(before) >= F.col(start))
    return starts.select(key, start, "n", F.coalesce(over, F.lit(False)).alias("overlapped"))


def open_before(rows: DataFrame, row_id: str, key: str, start: str, end: str) -> DataFrame:
    """(key, row_id, start, open_before): each row once for each row of its key that starts before and
    is open at ``start``, with that row's id; once with null where there is none.

    An end counts as within; a row without a key, a start or an end, or that ends before it starts, is
    open for none. A row stands once for each day that it touches and a start has one day, so a pair
    meets once, and a key with many rows meets only those of its day.
    """
    first, last = F.to_date("_from"), F.to_date("_till")
    earlier = rows.select(F.col(key).alias("_key"), F.col(row_id).alias("open_before"), F.col(start).alias("_from"), F.col(end).alias("_till")).where("_from <= _till").withColumn("_day", F.explode(F.sequence(first, last)))
    met = (F.col(key) == F.col("_key")) & (F.to_date(start) == F.col("_day")) & (F.col("_from") < F.col(start)) & (F.col(start) <= F.col("_till"))
    return rows.select(key, row_id, start).join(earlier, met, "left").select(key, row_id, start, "open_before")
