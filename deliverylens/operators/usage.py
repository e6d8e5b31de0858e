"""Usage of sessions that carry no run: read, priced, summed, and watched for what never came."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import temporal

COUNTS = ("input_tokens", "output_tokens", "cached_input_tokens", "cache_write_tokens", "reasoning_tokens", "request_count", "nano_aiu")
CONTEXT = ("tool_definitions_tokens", "system_tokens", "conversation_tokens")


def _count(name: str) -> Column:
    return F.get_json_object("attributes", f"$.{name}").try_cast("long").alias(name)


def session_calls(events: DataFrame, cutover: str) -> DataFrame:
    """(session_id, shutdown_at, model_id, counts, premium_requests) of model calls that name a session and no run, from the cutover's day on.

    Counts are read as whole numbers and are null if they can't be; premium
    requests are billed in fractions and stay decimal.
    """
    e = events.where((F.col("event_type") == "model.call") & F.col("run_id").isNull() & F.col("trace_id").isNotNull() & (F.to_date("event_time") >= F.lit(cutover).cast("date")))
    premium = F.get_json_object("attributes", "$.premium_requests").try_cast("decimal(18,6)")
    return e.select(F.col("trace_id").alias("session_id"), F.col("event_time").alias("shutdown_at"), F.get_json_object("attributes", "$.model_id").alias("model_id"), *[_count(c) for c in COUNTS], premium.alias("premium_requests"))


def priced(calls: DataFrame, book: DataFrame) -> DataFrame:
    """Calls with total_tokens, priceable, cost_nano and whether the price is a placeholder.

    book: model_id, effective_from, effective_to, p_in, p_out, p_cached (nano-dollars
    a token), placeholder. The price is that of the day of the shutdown; what the cache held is taken off the
    input; tokens written to the cache cost nothing of their own. A call is priceable if its rates are known,
    that of cached tokens only where there are any.
    """
    c = F.col
    zero = lambda name: F.coalesce(name, F.lit(0))
    rows = temporal.effective(calls.withColumn("_day", F.to_date("shutdown_at")), book, "model_id", "_day")
    cached = zero("cached_input_tokens")
    priceable = c("p_in").isNotNull() & c("p_out").isNotNull() & ((cached == 0) | c("p_cached").isNotNull())
    cost = F.greatest(zero("input_tokens") - cached, F.lit(0)) * c("p_in") + zero("output_tokens") * c("p_out") + cached * zero("p_cached")
    total = F.when(c("input_tokens").isNotNull() | c("output_tokens").isNotNull(), zero("input_tokens") + zero("output_tokens"))
    return rows.select(*calls.columns, total.alias("total_tokens"), priceable.alias("priceable"), F.when(priceable, cost).alias("cost_nano"), F.coalesce("placeholder", F.lit(False)).alias("placeholder"))


def by_session(rows: DataFrame) -> DataFrame:
    """Priced calls by session: sums keep nulls, and one call without a price makes the cost unknown."""
    sums = [F.sum(c).alias(c) for c in (*COUNTS, "total_tokens", "premium_requests")]
    cost = F.when(F.bool_and("priceable"), F.sum("cost_nano"))
    return rows.groupBy("session_id").agg(F.count("*").alias("model_calls"), *sums, cost.alias("cost_nano"), F.bool_or("placeholder").alias("placeholder"))


def phases(events: DataFrame) -> DataFrame:
    """(run_id, phases_ok, phases_failed) of phases that ended; a status that is neither counts for none."""
    status = F.get_json_object("attributes", "$.status")
    return events.where("event_type = 'run.phase.completed'").groupBy("run_id").agg(F.count_if(status == "ok").alias("phases_ok"), F.count_if(status == "failed").alias("phases_failed"))


def context_composition(events: DataFrame, week: Column) -> DataFrame:
    """(iso_week, known, unknown, the medians of the three parts, median, least and most of their sum): only calls that tell all three parts count.

    A session of several models tells no context; it is counted as unknown, not apportioned.
    """
    parts = [_count(c) for c in CONTEXT]
    e = events.where("event_type = 'model.call'").select(week.alias("iso_week"), *parts)
    total = F.col(CONTEXT[0]) + F.col(CONTEXT[1]) + F.col(CONTEXT[2])
    whole = total.isNotNull()
    mid = lambda x, name: F.median(F.when(whole, x)).alias(name)
    return e.groupBy("iso_week").agg(F.count_if(whole).alias("known"), F.count_if(~whole).alias("unknown"), *[mid(F.col(c), c.removesuffix("_tokens")) for c in CONTEXT], mid(total, "total"), F.min(total).alias("least"), F.max(total).alias("most"))


def session_findings(events: DataFrame, now: str, look_back: int = 14, quiet_h: int = 24, late_days: int = 21) -> DataFrame:
    """(session_id, severity, finding, amount) of sessions (trace_id that is no ``trc_``) seen in the look-back.

    medium: runs, no usage, and quiet for a day: the usage is unknown, not zero;
    amount counts runs. high: the first usage came over ``late_days`` whole days after the first
    event, when the runs had left the rebuilt window; amount counts days. The second can't
    happen within a look-back that is no longer than ``late_days``.
    """
    at = F.lit(now).cast("timestamp")
    usage = F.when(F.col("event_type") == "model.call", F.col("event_time"))
    e = events.where((F.to_date("event_time") >= F.date_sub(F.to_date(at), look_back)) & F.col("trace_id").isNotNull() & ~F.startswith("trace_id", F.lit("trc_")))
    s = e.groupBy("trace_id").agg(F.min("event_time").alias("a"), F.max("event_time").alias("b"), F.count_if(F.col("event_type") == "run.started").alias("runs"), F.count(usage).alias("n"), F.min(usage).alias("used"))
    days = F.floor((F.unix_micros("used") - F.unix_micros("a")) / 86_400_000_000)
    never = F.when((F.col("runs") > 0) & (F.col("n") == 0) & (F.col("b") < at - F.make_dt_interval(hours=F.lit(quiet_h))), F.struct(F.lit("medium").alias("severity"), F.lit("no usage").alias("finding"), F.col("runs").alias("amount")))
    late = F.when(days > late_days, F.struct(F.lit("high").alias("severity"), F.lit("late usage").alias("finding"), days.alias("amount")))
    return s.select(F.col("trace_id").alias("session_id"), F.explode(F.array_compact(F.array(never, late))).alias("f")).select("session_id", "f.*")
