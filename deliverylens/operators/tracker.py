"""Facts from landed issue, test and build payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deliverylens.functions.columns import rate

#: Link types in order of how strongly they tie an issue to its feature; test statuses.
LINK_PRIORITY = ("tests", "is tested by", "implements", "is implemented by", "blocks", "is blocked by", "causes", "is caused by", "relates", "relates to", "duplicates")
TEST_CATEGORIES = {
    "passed": "passed", "pass": "passed", "failed": "failed", "fail": "failed", "blocked": "blocked", "skipped": "skipped", "not applicable": "skipped", "n/a": "skipped",
    "in progress": "in_progress", "wip": "in_progress", "not run": "not_run", "notrun": "not_run", "no run": "not_run",
}
BUILD_STATES = {"successful": "success", "success": "success", "passed": "success", "failed": "failed", "failure": "failed", "error": "failed", "unstable": "failed", "stopped": "cancelled", "aborted": "cancelled", "expired": "cancelled"}


def category(status: Column, names: dict[str, str], other: str = "unknown") -> Column:
    table = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return F.coalesce(table[F.lower(F.trim(status))], F.lit(other))


def project(key: Column) -> Column:
    return F.split_part(key, F.lit("-"), F.lit(1))


def attributed_issue(issues: DataFrame, links: DataFrame) -> DataFrame:
    """(issue_key, target_key, source, confidence): the feature each issue delivers.

    issues: issue_key, parent_key. links: issue_key, nth (the place among the
    issue's links), target_key, link_type. A listed link out of the project (0.7)
    comes before one inside it (0.4), each by the list's order and then by
    place. A parent is taken where no listed link is, or if it is in another
    project: 0.6, inside the project 0.5, never less than the link had. Else any
    link is (0.2). Issues with neither have null and 0.
    """
    rank = F.array_position(F.array(*[F.lit(x) for x in LINK_PRIORITY]), F.lower(F.trim("link_type")))
    rank = F.coalesce(F.when(rank > 0, rank), F.lit(len(LINK_PRIORITY) + 1))
    level = F.when(rank > len(LINK_PRIORITY), 2).when(project(F.col("target_key")) != project(F.col("issue_key")), 0).otherwise(1)
    order = F.struct(level.alias("level"), F.when(level < 2, rank).otherwise(0).alias("rank"), "nth", "target_key", "link_type")
    best = links.groupBy("issue_key").agg(F.min(order).alias("x"))
    row = issues.select("issue_key", "parent_key").join(best, "issue_key", "left")
    listed = F.coalesce(F.col("x.level") < 2, F.lit(False))
    away = project(F.col("parent_key")) != project(F.col("issue_key"))
    parent = F.col("parent_key").isNotNull() & (~listed | away)
    from_link = F.when(F.col("x.level") == 0, 0.7).when(F.col("x.level") == 1, 0.4)
    sure = F.when(parent, F.greatest(F.when(away, 0.6).otherwise(0.5), from_link)).otherwise(F.coalesce(from_link, F.when(F.col("x").isNotNull(), 0.2), F.lit(0.0)))
    return row.select("issue_key", F.when(parent, F.col("parent_key")).otherwise(F.col("x.target_key")).alias("target_key"), F.when(parent, "parent").otherwise(F.concat(F.lit("issue_link:"), "x.link_type")).alias("source"), sure.alias("confidence"))


def status_transitions(issues: DataFrame, changes: DataFrame) -> DataFrame:
    """Status changes of issues with a made-up first one at creation, and the age at each.

    issues: issue_key, created_at, status. changes: issue_key, at, field, from_value, to_value.
    """
    moves = changes.where("field = 'status'").select("issue_key", "at", F.col("from_value").alias("from_status"), F.col("to_value").alias("to_status"))
    w = Window.partitionBy("issue_key").orderBy("at", "to_status")
    first = moves.withColumn("nth", F.row_number().over(w)).where("nth = 1").select("issue_key", F.col("from_status").alias("was"))
    born = issues.join(first, "issue_key", "left").select("issue_key", F.col("created_at").alias("at"), F.lit(None).cast("string").alias("from_status"), F.coalesce("was", "status").alias("to_status"))
    both = born.unionByName(moves).join(issues.select("issue_key", "created_at"), "issue_key")
    return both.withColumn("age_ms", F.expr("timestampdiff(MILLISECOND, created_at, at)")).drop("created_at")


def test_runs(runs: DataFrame) -> DataFrame:
    """Test run events: a run that never ran has no time."""
    c = F.when(F.coalesce(F.trim("status"), F.lit("")) == "", "not_run").otherwise(category(F.col("status"), TEST_CATEGORIES, "other"))
    return runs.withColumn("status_category", c).withColumn("executed_at", F.when(c != "not_run", F.col("executed_at"))).withColumn("defect_count", F.size(F.coalesce("defects", F.array().cast("array<string>"))))


#: Categories of runs that took place.
EXECUTED = ("passed", "failed", "blocked", "skipped")


def cycles_in_window(cycles: DataFrame, since: str | None) -> DataFrame:
    """Cycles of which any of updated_at, created_at, start_at or end_at is at ``since`` or later; those without any time stay.

    The creation alone would drop a long cycle that is still being run.
    """
    if since is None:
        return cycles
    last = F.greatest("updated_at", "created_at", "start_at", "end_at")  # of those that are known
    return cycles.where(last.isNull() | (last >= F.lit(since).cast("timestamp")))


def run_pass(cycles: DataFrame, runs: DataFrame, since: str | None, include_not_run: bool = False) -> DataFrame:
    """The runs (cycle_key, status, executed_at, defects, ...) of cycles in the window, by ``test_runs``.

    A new cycle has a row a case at "not run": these are plans, and stay out unless
    asked for. Cycles without a key are left out; one listed twice gives its runs once.
    """
    keys = cycles_in_window(cycles, since).where("cycle_key IS NOT NULL").select("cycle_key")
    out = test_runs(runs.join(keys, "cycle_key", "left_semi"))
    return out if include_not_run else out.where("status_category != 'not_run'")


def test_totals(runs: DataFrame, by: str) -> DataFrame:
    """Counts of each category, of all that were executed, and the share that passed of these; runs that were not run
    are in no denominator, those without a category are ``other``."""
    c = F.coalesce("status_category", F.lit("other"))
    n = lambda *names: F.count_if(c.isin(*names))
    each = [n(x).alias(x) for x in (*EXECUTED, "in_progress", "not_run", "other")]
    return runs.groupBy(by).agg(*each, n(*EXECUTED).alias("executed"), F.round(rate(n("passed"), n(*EXECUTED)), 1).alias("pass_rate"))


def build_events(builds: DataFrame) -> DataFrame:
    """Builds with one status list, their duration, and test counts from either report shape.

    builds: build_id, state, started_at, ended_at, report (JSON: either
    total/failed/skipped, or passCount/failCount/skipCount).
    """
    get = lambda k: F.get_json_object("report", f"$.{k}").try_cast("long")
    failed, skipped = F.coalesce(get("failed"), get("failCount")), F.coalesce(get("skipped"), get("skipCount"))
    total = F.coalesce(get("total"), get("passCount") + get("failCount") + F.coalesce(get("skipCount"), F.lit(0)))
    span = F.expr("timestampdiff(MILLISECOND, started_at, ended_at)")
    return builds.select(
        "build_id", category(F.col("state"), BUILD_STATES, "running").alias("status"), F.when(span >= 0, span).alias("duration_ms"),
        total.alias("tests_total"), failed.alias("tests_failed"), skipped.alias("tests_skipped"), (total - failed - F.coalesce(skipped, F.lit(0))).alias("tests_passed"),
    )


def step_totals(steps: DataFrame) -> DataFrame:
    """Build steps put together: null time if none is known, never zero."""
    return steps.groupBy("build_id").agg(F.count("*").alias("steps"), F.sum("duration_ms").alias("duration_ms"), F.count_if(F.col("status") == "failed").alias("failed_steps"))
