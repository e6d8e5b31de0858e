"""Facts from landed pull requests: reviews, comments, diffs, commits, links, reverts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deliverylens.functions.columns import first_match

#: Hints of automated accounts (parts of a name, in any case), and file kinds by path.
BOT_HINTS = ("bot", "jenkins", "sonarqube", "sonarcloud", "snyk", "dependabot", "renovate", "codecov", "coveralls", "pipelines", "automation", "service-account", "svc-", "noreply")
AUTOMATION_KINDS = {
    "feature": r"(?i)\.feature$",
    "step_definition": r"(?i)[._-]steps?\.(ts|js|tsx|jsx|py|java)$",
    "spec": r"(?i)(\.|_)(spec|test)\.(ts|js|tsx|jsx)$|(^|/)test_[^/]+\.py$|[._-]test\.py$|Test\.java$",
    "page_object": r"(?i)(^|/)(pages?|page[-_]?objects?|locators?)/|[._-]page\.(ts|js|py)$",
    "fixture": r"(?i)(^|/)(fixtures?|test[-_]?data|testdata|mocks?|stubs?)/|(^|/)(tests?|e2e|specs?)/.*\.(csv|json|ya?ml|xlsx?)$",
}
SCRIPT_KINDS = ("feature", "spec", "step_definition")
MAX_RUNS, MAX_SHAS = 20, 200


def is_bot(name: Column, kind: Column | None = None, account: Column | None = None) -> Column:
    """Whether an account is machinery: by a hint in its names, as an app or add-on, or as nobody at all (no name and no account)."""
    named = F.coalesce(F.lower(F.trim(name)), F.lit(""))
    out = F.exists(F.array(*[F.lit(h) for h in BOT_HINTS]), lambda h: F.contains(named, h)) | ((named == "") & (F.lit(True) if account is None else account.isNull()))
    return out if kind is None else out | F.coalesce(F.lower(kind).isin("app", "addon"), F.lit(False))


def _user(rows: DataFrame) -> tuple[Column, Column]:
    """(who acted, whether it is machinery) of rows with a user's name and, where the source has them, account and user_type."""
    has = rows.columns
    account = F.col("account") if "account" in has else None
    who = F.col("user") if account is None else F.coalesce(account, F.col("user"))
    return who, is_bot(F.col("user"), F.col("user_type") if "user_type" in has else None, account)


def decline_reason(declined_by: Column, author: Column, changes_requested: Column) -> Column:
    """Why a request was declined: by its author, after requested changes, by another, or unknown."""
    return F.when(declined_by == author, "declined_by_author").when(changes_requested, "changes_requested_unresolved").when(declined_by.isNotNull(), "declined_by_reviewer").otherwise("unknown")


def review_timeline(prs: DataFrame, activity: DataFrame) -> DataFrame:
    """One row a request: first review, reviewers with their strongest action, revisions, reopens.

    prs: pr_id, author. activity: pr_id, kind (update, approval,
    changes_requested, comment), at, user, state; account and user_type if known.
    Actions of the author and of automated accounts are no review, nor are those of
    nobody; an account without a name counts by itself.
    """
    who, bot = _user(activity)
    a = activity.withColumns({"user": who, "_bot": bot}).join(prs.select("pr_id", "author"), "pr_id")
    acts = a.where(F.col("kind").isin("approval", "changes_requested", "comment") & ~F.col("user").eqNullSafe(F.col("author")) & ~F.col("_bot"))
    strength = F.when(F.col("kind") == "approval", 3).when(F.col("kind") == "changes_requested", 2).otherwise(1)
    per = acts.groupBy("pr_id", F.col("user").alias("reviewer")).agg(F.min("at").alias("at"), F.max(strength).alias("s"))
    names = F.when(F.col("s") == 3, "approved").when(F.col("s") == 2, "changes_requested").otherwise("commented")
    reviews = per.groupBy("pr_id").agg(
        F.min("at").alias("first_review_at"),
        F.min_by("reviewer", F.struct("at", "reviewer")).alias("first_reviewer"),
        F.count("*").alias("reviewer_count"),
        F.count_if(F.col("s") == 3).alias("approvals"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("reviewer", names.alias("action"))))).alias("actions"),
    )
    w = Window.partitionBy("pr_id")
    upd = a.where("kind = 'update'").withColumn("_declined", F.min(F.when(F.col("state") == "DECLINED", F.col("at"))).over(w))
    moves = upd.groupBy("pr_id").agg(F.greatest(F.count_if(F.col("state") == "OPEN") - 1, F.lit(0)).alias("revisions"), F.count_if((F.col("state") == "OPEN") & (F.col("at") > F.col("_declined"))).alias("reopens"))
    return prs.join(reviews, "pr_id", "left").join(moves, "pr_id", "left").fillna(0, ["reviewer_count", "approvals", "revisions", "reopens"])


def comment_summary(prs: DataFrame, comments: DataFrame) -> DataFrame:
    """Counts of a request's comments: by place, the author's own, automated and deleted ones apart."""
    who, bot = _user(comments)
    c = comments.withColumns({"user": who, "bot": bot}).join(prs.select("pr_id", "author"), "pr_id").withColumn("own", F.col("user").eqNullSafe(F.col("author")))
    real = ~F.col("deleted") & ~F.col("bot")
    per = c.where(real & F.col("user").isNotNull()).groupBy("pr_id", "user").count().groupBy("pr_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("user", "count")))).alias("by_person"))
    total = c.groupBy("pr_id").agg(
        F.count_if(real & F.col("inline")).alias("inline"), F.count_if(real & ~F.col("inline")).alias("top_level"), F.count_if(real & F.col("own")).alias("by_author"), F.count_if(F.col("bot")).alias("by_bots"), F.count_if("deleted").alias("deleted")
    )
    return total.join(per, "pr_id", "left")


def diffstat_summary(files: DataFrame) -> DataFrame:
    """Lines and files of a request, files by automation kind and status, scripts added."""
    f = files.withColumn("kind", first_match(F.coalesce("new_path", "old_path"), AUTOMATION_KINDS))
    kinds = f.where("kind IS NOT NULL").groupBy("pr_id", "kind").agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("added", "modified", "removed")])
    by_kind = kinds.groupBy("pr_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("kind", F.struct("added", "modified", "removed"))))).alias("files_by_kind"))
    script = F.col("kind").isin(*SCRIPT_KINDS)
    total = f.groupBy("pr_id").agg(
        F.sum("lines_added").alias("lines_added"), F.sum("lines_removed").alias("lines_removed"), F.count("*").alias("files_changed"),
        F.count_if(script & (F.col("status") == "added")).alias("scripts_added"), F.count_if(script & (F.col("status") == "modified")).alias("scripts_modified"),
    )
    return total.join(by_kind, "pr_id", "left")


def commit_summary(commits: DataFrame) -> DataFrame:
    """Marked commits, and the first run ids and shas that a request's commits name."""
    firsts = lambda c, n: F.slice(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct("at", "sha", F.col(c).alias("v"))))), lambda x: x["v"])), 1, n)
    return commits.groupBy("pr_id").agg(F.count("*").alias("commit_count"), F.count_if("marked").alias("ai_commits"), firsts("run_id", MAX_RUNS).alias("run_ids"), firsts("sha", MAX_SHAS).alias("shas"))


def link(run_ids: Column, marked: Column, key: Column) -> Column:
    """struct(method, confidence, run_id): a trailer is explicit, then a marker, then a key."""
    has = F.size(F.coalesce(run_ids, F.array().cast("array<string>")))
    return F.struct(
        F.when(has > 0, "explicit").when(marked, "marker_only").when(key.isNotNull(), "heuristic").alias("method"),
        F.when(has > 0, 1.0).when(marked, 0.3).when(key.isNotNull(), 0.5).otherwise(0.0).alias("confidence"),
        F.when(has == 1, run_ids[0]).alias("run_id"),
    )


def review_churn(commits: DataFrame, timeline: DataFrame) -> DataFrame:
    """Lines changed after the first review; null if nobody reviewed or a commit's diff is unknown."""
    c = commits.join(timeline.select("pr_id", "first_review_at"), "pr_id")
    after = F.sum(F.when(F.col("at") > F.col("first_review_at"), F.col("lines")).otherwise(0))
    return c.groupBy("pr_id").agg(F.when(F.bool_and(F.col("lines").isNotNull()) & F.max("first_review_at").isNotNull(), after).alias("lines_after_review"))


def pair_reverts(reverts: DataFrame, merges: DataFrame) -> DataFrame:
    """(revert_id, pr_id, how, days): reverts paired with what they revert.

    By full sha, else by an abbreviated one that fits one merge of the
    repository, else by the latest earlier merge with the quoted subject;
    otherwise unresolved. reverts: revert_id, repo, at, sha, subject; merges:
    pr_id, repo, merged_at, sha, subject.
    """
    m = merges.select("pr_id", "repo", "merged_at", F.col("sha").alias("m_sha"), F.col("subject").alias("m_subject"), F.substring("sha", 1, 7).alias("m7"))
    r = reverts.withColumn("r7", F.substring("sha", 1, 7))
    same = r.join(m, (r["repo"] == m["repo"]) & (r["r7"] == m["m7"]) & F.startswith(m["m_sha"], r["sha"])).select("revert_id", "at", "pr_id", "merged_at", (F.length("sha") >= 40).alias("full"))
    by_sha = same.groupBy("revert_id").agg(F.when(F.count_distinct("pr_id") == 1, F.min("pr_id")).alias("pr_id"), F.min("merged_at").alias("merged_at"), F.when(F.bool_or("full"), "sha").otherwise("prefix").alias("how")).where("pr_id IS NOT NULL")
    rest = r.join(by_sha, "revert_id", "left_anti")
    named = rest.join(m, (rest["repo"] == m["repo"]) & (rest["subject"] == m["m_subject"]) & (m["merged_at"] < rest["at"]))
    by_name = named.groupBy("revert_id").agg(F.max_by("pr_id", F.struct("merged_at", "pr_id")).alias("pr_id"), F.max("merged_at").alias("merged_at"), F.lit("subject").alias("how"))
    found = by_sha.unionByName(by_name)
    out = r.join(found, "revert_id", "left")
    return out.select("revert_id", "pr_id", F.coalesce("how", F.lit("unresolved")).alias("how"), F.round((F.unix_micros("at") - F.unix_micros("merged_at")) / 86_400_000_000, 4).alias("days"))
