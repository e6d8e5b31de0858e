"""People's reports held against the trails that systems leave."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def near_days(trail: DataFrame, key: str, tolerance: int) -> DataFrame:
    """(key, day), once each: the days within ``tolerance`` days of one on which the key (of trail: key, day) has activity.

    Days are widened on the trail's side, after they are made distinct, so that the
    match is an equality and a busy key sends one row a day.
    """
    days = trail.select(F.col("key").alias(key), F.to_date("day").alias("day")).where(f"{key} IS NOT NULL AND day IS NOT NULL").distinct()
    span = F.sequence(F.date_sub("day", tolerance), F.date_add("day", tolerance))
    return days.select(key, F.explode(span).alias("day")).distinct()


def judged(reports: DataFrame, issues: DataFrame, cases: DataFrame, tolerance: int = 1) -> DataFrame:
    """(issue_key, case_key, day, n, in_issues, in_cases): reports of one issue, case and day are one row, counted.

    reports: issue_key, case_key, day. A row without a day, or one that is no
    date, has no trail; nothing is dropped.
    """
    r = reports.select("issue_key", "case_key", F.try_to_date(F.col("day").cast("string"), "yyyy-MM-dd").alias("day")).groupBy("issue_key", "case_key", "day").agg(F.count("*").alias("n"))
    i = near_days(issues, "issue_key", tolerance).withColumn("_i", F.lit(True))
    c = near_days(cases, "case_key", tolerance).withColumn("_c", F.lit(True))
    seen = lambda name: F.coalesce(name, F.lit(False))
    return r.join(i, ["issue_key", "day"], "left").join(c, ["case_key", "day"], "left").select("issue_key", "case_key", "day", "n", seen("_i").alias("in_issues"), seen("_c").alias("in_cases"))


def mappings(rows: DataFrame) -> DataFrame:
    """(issue_key, case_key, observations, both_trails_agree, days, confidence) of judged rows that name a case.

    A pair is corroborated once both trails show it on the same report; one-sided
    agreement stays reported_only. ``days``: the reported dates, in order.
    """
    agree = F.sum(F.when(F.col("in_issues") & F.col("in_cases"), F.col("n")).otherwise(0))
    out = rows.where("case_key != ''").groupBy("issue_key", "case_key").agg(F.sum("n").alias("observations"), agree.alias("both_trails_agree"), F.array_sort(F.collect_set("day")).alias("days"))
    return out.withColumn("confidence", F.when(F.col("both_trails_agree") > 0, "corroborated").otherwise("reported_only"))


def completeness(rows: DataFrame, issues: DataFrame) -> DataFrame:
    """One row: how many reports have a trail near their day, and how many reported issues have any trail at all.

    The two differ on purpose: an issue with a trail on other days is a question of
    when, one without any of whether. pct is null without rows.
    """
    key = rows.groupBy("issue_key").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("in_issues"), F.col("n")).otherwise(0)).alias("near"))
    known = issues.select(F.col("key").alias("issue_key"), F.to_date("day").alias("d")).where("d IS NOT NULL").select("issue_key").distinct().withColumn("_k", F.lit(1))
    total = F.coalesce(F.sum("n"), F.lit(0))
    near = F.coalesce(F.sum("near"), F.lit(0))
    return key.join(known, "issue_key", "left").agg(
        total.alias("n_rows"), near.alias("rows_with_trail"), (total - near).alias("rows_without_trail"), F.round(F.try_divide(F.lit(100.0) * near, F.nullif(total, F.lit(0))), 1).alias("pct"),
        F.count("issue_key").alias("issues_reported"), F.count(F.when(F.col("issue_key").isNotNull(), F.col("_k"))).alias("issues_with_trail"),
    )
