"""What a repository's log tells, as event envelopes; what may not leave is told before they do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deliverylens.functions import columns as C

from . import ingest

#: The contract's version; what a commit is worth as a link without a run.
SCHEMA_VERSION = "1.1.0"
MARKED, FILE_OF_MARKED = 0.3, 0.4
LONGEST_VALUE = 200
ENVELOPE = ("schema_version", "event_id", "event_type", "event_time", "ingested_at", "trace_id", "run_id", "parent_run_id", "span_id", "actor", "context", "agent", "attributes", "link")


def numstat(text: Column) -> Column:
    """array<struct<added, removed, path>> of ``added<tab>removed<tab>path`` lines. Binary files (``-``) and other lines are none."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"^\d+\t\d+\t[^\t]*$"))
    part = lambda x, k: F.split_part(x, F.lit("\t"), F.lit(k))
    return F.transform(lines, lambda x: F.struct(part(x, 1).cast("long").alias("added"), part(x, 2).cast("long").alias("removed"), part(x, 3).alias("path")))


def envelope(event_type: str, key: list[Column], at: Column, attributes: Column, *, run_id: Column, trace_id: Column, email_hash: Column, issue: Column, repo: Column, branch: Column, agent: str, unlinked: tuple[str, float]) -> list[Column]:
    """The columns of an event: its id follows from type and natural key, so that the same fact told twice is one
    event. A run makes the link explicit, with full confidence; else it is ``unlinked``. ingested_at is the service's to set."""
    none = F.lit(None).cast("string")
    linked = run_id.isNotNull()
    return [
        F.lit(SCHEMA_VERSION).alias("schema_version"), C.derived_id("evt", F.lit(event_type), *key).alias("event_id"), F.lit(event_type).alias("event_type"), at.alias("event_time"), F.lit(None).cast("timestamp").alias("ingested_at"),
        trace_id.cast("string").alias("trace_id"), run_id.alias("run_id"), none.alias("parent_run_id"), none.alias("span_id"),
        F.struct(none.alias("person_id"), email_hash.cast("string").alias("person_email_hash"), none.alias("team_id"), none.alias("role")).alias("actor"),
        F.struct(issue.alias("jira_issue_key"), F.regexp_extract(issue, r"^(.*)-\d+$", 1).alias("jira_project_key"), repo.alias("repo_full_name"), branch.alias("branch_name")).alias("context"),
        F.struct(F.lit(agent).alias("agent_name"), F.lit("headless").alias("surface")).alias("agent"),
        F.to_json(attributes).alias("attributes"),
        F.struct(F.when(linked, "explicit").otherwise(unlinked[0]).alias("method"), F.when(linked, 1.0).otherwise(unlinked[1]).alias("confidence")).alias("link"),
    ]


def commit_events(commits: DataFrame, projects: list[str], salt: str | None, agent: str = "client.git") -> DataFrame:
    """A ``scm.commit`` each commit and, where AI had a hand in it, an ``output.generated`` each file.

    commits: repo, branch, sha, authored (time), email, message, stats (numstat
    text). A run in a trailer or the marker in the subject is AI's hand; files of
    other commits are people's work and make no output. Of message and address
    nothing but key, marker and salted hash goes on. Commits without a sha are
    left out; those with a null message have no run, marker or key. A commit that
    is told twice gives two rows of one id each, for the dedup to settle.
    """
    subject = F.split_part(F.col("message"), F.lit("\n"), F.lit(1))
    c = commits.where("sha IS NOT NULL").select(
        "repo", "branch", "sha", "authored", C.email_hash(F.col("email"), salt).alias("by"), C.trailer(F.col("message"), "AI-Run-Id").alias("run"), C.trailer(F.col("message"), "AI-Trace-Id").alias("trace"),
        C.issue_key([subject, F.col("branch")], projects).alias("issue"), F.coalesce(C.has_marker(F.col("message")), F.lit(False)).alias("marked"), numstat(F.col("stats")).alias("files"),
    )
    total = lambda f: F.aggregate("files", F.lit(0).cast("long"), lambda a, x: a + x[f])
    none = F.lit(None).cast("string")
    same = dict(run_id=F.col("run"), issue=F.col("issue"), repo=F.col("repo"), branch=F.col("branch"), agent=agent)
    facts = F.struct(F.col("sha").alias("commit_sha"), total("added").alias("lines_added"), total("removed").alias("lines_removed"), F.col("marked").alias("has_ai_marker"))
    whole = c.select(*envelope("scm.commit", [F.col("repo"), F.col("sha")], F.col("authored"), facts, trace_id=F.col("trace"), email_hash=F.col("by"), unlinked=("marker_only", MARKED), **same))
    each = c.where("run IS NOT NULL OR marked").select("*", F.explode("files").alias("f"))
    path = F.col("f.path")
    made = F.struct(C.derived_id("out", F.col("sha"), path).alias("output_id"), C.first_match(path, C.ARTIFACT_TYPES, "code").alias("artifact_type"), path.alias("file_path"), F.col("f.added").alias("lines_added"), F.col("f.removed").alias("lines_removed"))
    return whole.unionByName(each.select(*envelope("output.generated", [F.col("repo"), F.col("sha"), path], F.col("authored"), made, trace_id=none, email_hash=none, unlinked=("heuristic", FILE_OF_MARKED), **same)))


def envelope_fault(df: DataFrame) -> Column:
    """The first way in which an envelope breaks the contract, else null."""
    odd = sorted(set(df.columns) ^ set(ENVELOPE))
    if odd:
        return F.lit("keys:" + ",".join(odd))
    bad = lambda ok: ~F.coalesce(ok, F.lit(False))
    return (
        F.when(bad(F.col("event_type").isin(*ingest.EVENT_TYPES)), "event_type")
        .when(bad(F.col("schema_version") == SCHEMA_VERSION), "schema_version")
        .when(F.col("ingested_at").isNotNull(), "ingested_at")
        .when(bad(F.col("link.method").isin(*ingest.ENUMS["link_method"])), "link.method")
        .when((F.col("link.method") == "explicit") & bad(F.col("link.confidence") == 1.0), "link.confidence")
    )


def content_leaks(events: DataFrame, allowed: dict[str, list[str]]) -> DataFrame:
    """(event_id, event_type, name, problem): what must not leave the machine, by name, never by value.

    A type or an attribute that the lists lack, a value below somebody's home
    folder, a value of over 200 characters (content, by its length). Events with
    attributes that are null or no object have none to look at.
    """
    names = F.create_map(*[x for k, v in allowed.items() for x in (F.lit(k), F.array(*[F.lit(y) for y in v]))])
    known = names[F.col("event_type")]
    e = events.select("event_id", "event_type", known.alias("_known"), F.from_json("attributes", "map<string,string>").alias("_a"))
    odd_type = e.where("_known IS NULL").select("event_id", "event_type", F.lit(None).cast("string").alias("name"), F.lit("unknown type").alias("problem"))
    a = e.where("_known IS NOT NULL").select("event_id", "event_type", "_known", F.explode("_a").alias("name", "_v"))
    problem = (
        F.when(~F.array_contains("_known", F.col("name")), "not allowed")
        .when(F.col("_v").rlike(r"^/(Users|home)/|[\s\"'=]/(Users|home)/"), "absolute path")
        .when(F.length("_v") > LONGEST_VALUE, "long value")
    )
    return odd_type.unionByName(a.select("event_id", "event_type", "name", problem.alias("problem")).where("problem IS NOT NULL"))


def shippable(events: DataFrame, leaks: DataFrame) -> DataFrame:
    """The events of which nothing leaks; one bad event doesn't hold back the others."""
    return events.join(leaks.select("event_id").distinct(), "event_id", "left_anti")
