"""Reports as nested documents: sections with what each rests on, so that no data is never read as zero."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deliverylens.functions.columns import iso_week, k_guard, rate, trend_word

METRICS = ("prompts", "sessions", "active_days", "tool_calls", "tool_errors", "tool_error_rate", "model_calls", "tokens_in", "gates_passed", "gates_failed")


def section(rows: Column, **values: Column) -> Column:
    """struct(basis, values): ``measured`` if a row stands behind it, else ``no_data`` and nulls."""
    seen = F.coalesce(rows > 0, F.lit(False))
    return F.struct(F.when(seen, "measured").otherwise("no_data").alias("basis"), *[F.when(seen, v).alias(n) for n, v in values.items()])


def _totals() -> list[Column]:
    """Aggregates of events (person_id, session, at, kind, status, tokens_in)."""
    is_ = lambda k: F.col("kind") == k
    n = lambda cond, name: F.count_if(cond).alias(name)
    return [
        F.count("*").alias("events"), n(is_("human.turn"), "prompts"), F.count_distinct("session").alias("sessions"), F.count_distinct(F.to_date("at")).alias("active_days"),
        n(is_("tool.call"), "tool_calls"), n(is_("tool.call") & F.col("status").isNotNull(), "tool_known"), n(is_("tool.call") & (F.col("status") == "error"), "errors"),
        n(is_("model.call"), "model_calls"), F.sum(F.when(is_("model.call"), F.col("tokens_in"))).alias("tokens_in"),
        n(is_("gate.evaluated"), "gates"), n(is_("gate.evaluated") & F.col("status").isNotNull(), "gates_known"), n(is_("gate.evaluated") & (F.col("status") == "pass"), "passed"), n(is_("gate.evaluated") & (F.col("status") == "fail"), "failed"),
    ]


def _sections() -> Column:
    c = F.col
    errors = F.when(c("tool_known") > 0, c("errors"))
    return F.struct(
        section(c("events"), prompts=c("prompts"), sessions=c("sessions"), active_days=c("active_days")).alias("activity"),
        section(c("tool_calls"), tool_calls=c("tool_calls"), tool_errors=errors, tool_error_rate=k_guard(c("tool_known"), F.round(rate(errors, c("tool_known")), 1))).alias("tools"),
        section(c("model_calls"), model_calls=c("model_calls"), tokens_in=c("tokens_in")).alias("models"),
        section(c("gates"), gates_passed=F.when(c("gates_known") > 0, c("passed")), gates_failed=F.when(c("gates_known") > 0, c("failed"))).alias("gates"),
    )


def weekly_payloads(events: DataFrame) -> DataFrame:
    """(iso_week, payload): the JSON document of each week: its reach and a section for each kind of event."""
    e = events.withColumn("iso_week", iso_week(F.col("at")))
    weeks = e.groupBy("iso_week").agg(F.count_distinct("person_id").alias("people"), *_totals())
    return weeks.select("iso_week", F.to_json(F.struct("iso_week", "people", "events", _sections().alias("sections")), {"ignoreNullFields": "false"}).alias("payload"))


def person_snapshots(events: DataFrame, first_week: str, last_week: str) -> DataFrame:
    """(person_id, payload): a JSON document for each person: a row for every week from first to last (Mondays), the
    ten metrics of each, which weeks are whole, and the trend of prompts over the whole weeks.

    A week without an event of the person is ``no_data``, never zero. A week is whole if
    the events at hand, of anyone, reach past its Sunday; volumes are compared over whole weeks only.
    """
    e = events.withColumn("wk", F.to_date(F.date_trunc("week", "at")))
    per = e.groupBy("person_id", "wk").agg(*_totals())
    end = e.agg(F.max(F.to_date("at")).alias("end"))  # one row
    span = F.explode(F.sequence(F.lit(first_week).cast("date"), F.lit(last_week).cast("date"), F.expr("INTERVAL 7 DAYS")))
    spine = e.select("person_id").distinct().select("person_id", span.alias("wk")).crossJoin(F.broadcast(end))
    rows = spine.join(per, ["person_id", "wk"], "left")
    whole = F.date_add("wk", 6) <= F.col("end")
    week = F.struct("wk", whole.alias("whole"), _sections().alias("sections"))
    docs = rows.groupBy("person_id").agg(F.array_sort(F.collect_list(week)).alias("weeks"))
    points = F.transform(F.filter("weeks", lambda w: w["whole"]), lambda w: w["sections"]["activity"]["prompts"])
    return docs.select("person_id", F.to_json(F.struct("person_id", trend_word(points).alias("trend"), "weeks"), {"ignoreNullFields": "false"}).alias("payload"))
