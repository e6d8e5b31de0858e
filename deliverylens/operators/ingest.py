"""Validation of events on their way in: rejects, stripped names, clamps and flags.

``admit`` is one plan of row expressions; batch and stream call the same one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the event contract.
EVENT_TYPES = (
    "ci.pipeline.completed", "gate.evaluated", "human.turn", "jira.transition", "model.call", "output.generated", "run.abandoned", "run.bound", "run.completed", "run.failed", "run.phase.completed", "run.phase.started",
    "run.started", "run.timeout", "scm.commit", "scm.pr.created", "scm.pr.declined", "scm.pr.merged", "scm.pr.reviewed", "scm.revert", "test.case.snapshot", "test.run.completed", "tool.call",
)
FORBIDDEN_KEYS = ("api_key", "body", "code", "content", "diff", "email", "error_message", "message", "password", "prompt", "response", "secret", "stack_trace", "text", "token")
ENUMS = {
    "role": ("dev", "devops", "lead", "po", "qa"),
    "environment": ("dev", "local", "prd", "pre", "sit"),
    "surface": ("copilot-cli", "headless", "unknown", "vscode-copilot-chat"),
    "link_method": ("explicit", "heuristic", "marker_only"),
}
#: Fixed values in the contract's order: the first that fits is the one reported.
SECRETS_STRICT = {
    "password_assignment": r"(?i)password\s*[=:]\s*['\"]?[^'\"\s]{4,}",
    "api_key_assignment": r"(?i)api[_-]?key\s*[=:]\s*['\"]?[^'\"\s]{8,}",
    "secret_assignment": r"(?i)\bsecret\s*[=:]\s*['\"]?[^'\"\s]{4,}",
    "private_key_block": r"-{0,5}BEGIN[ A-Z0-9]*PRIVATE KEY",
    "aws_access_key_id": r"\bAKIA[0-9A-Z]{16}\b",
    "atlassian_api_token": r"\bATATT[A-Za-z0-9_\-=]{16,}",
    "github_token": r"\bgh[pousr]_[A-Za-z0-9]{16,}\b",
}
SECRETS_LENIENT = {
    "password_assignment": r"(?i)password\s*=",
    "api_key_literal": r"(?i)api[_-]?key",
    "private_key_block": r"BEGIN[ A-Z]*PRIVATE KEY",
    "aws_access_key_id": r"AKIA[0-9A-Z]{16}",
    "atlassian_api_token": r"ATATT[A-Za-z0-9_\-=]{8,}",
    "github_token": r"gh[pousr]_[A-Za-z0-9]{16,}",
}
EMAIL = r"[^\s@<>,;:\"']+@[^\s@<>,;:\"']+\.[A-Za-z]{2,}"
AHEAD_S = 300


def json_keys(text: Column | str) -> Column:
    """All keys of a JSON text at any depth, lower-cased; escapes are taken out first."""
    plain = F.regexp_replace(text, r"\\.", "")
    return F.transform(F.regexp_extract_all(plain, F.lit(r'"([^"]*)"\s*:'), F.lit(1)), F.lower)


def top_keys(text: Column | str) -> Column:
    return F.coalesce(F.json_object_keys(text), F.array().cast("array<string>"))


def json_values(text: Column | str) -> Column:
    """A JSON text without its keys: what value screens look at."""
    return F.regexp_replace(text, r'"(?:[^"\\]|\\.)*"\s*:', ":")


def forbidden(text: Column | str) -> Column:
    """Forbidden names among the keys: whole names, at any depth, in any case."""
    return F.array_intersect(json_keys(text), F.array(*[F.lit(k) for k in FORBIDDEN_KEYS]))


def secrets(text: Column | str, patterns: dict[str, str] = SECRETS_STRICT) -> Column:
    """The names of the patterns that a value matches; the value itself is never kept."""
    values = json_values(text)
    return F.array_compact(F.array(*[F.when(values.rlike(p), F.lit(k)) for k, p in patterns.items()]))


def reject_reason(df: DataFrame) -> Column:
    """The first rule that an event breaks, else null. Where the rows tell it
    (has_run_id), the key ``run_id`` must be there; its value may be null."""
    version = F.col("schema_version")
    missing = F.coalesce(*[F.when(F.col(c).isNull() | (F.col(c) == ""), F.lit(f"missing:{c}")) for c in ("schema_version", "event_id", "event_type", "event_time_text", "trace_id")])
    return (
        F.when(missing.isNotNull(), missing)
        .when(~F.col("has_run_id") if "has_run_id" in df.columns else F.lit(False), "missing:run_id")
        .when(~version.rlike(r"^\d+\.\d+\.\d+$") | (F.split_part(version, F.lit("."), F.lit(1)) != "1"), "schema_version")
        .when(~F.col("event_type").isin(*EVENT_TYPES), "event_type")
        .when(F.size(forbidden("attributes")) > 0, F.concat(F.lit("forbidden:"), forbidden("attributes")[0]))
        .when(F.size(secrets("attributes")) > 0, F.concat(F.lit("secret:"), secrets("attributes")[0]))
    )


def extra_attributes(allowed: dict[str, list[str]]) -> Column:
    """Attribute names that the event type's list doesn't have: importers reject
    an event that has any, where the ingest service strips them."""
    names = F.create_map(*[x for k, v in allowed.items() for x in (F.lit(k), F.array(*[F.lit(y) for y in v]))])
    return F.array_sort(F.array_except(top_keys("attributes"), F.coalesce(names[F.col("event_type")], F.array().cast("array<string>"))))


def relative_path(path: Column, roots: list[str]) -> Column:
    """A path below the longest of the roots that holds it; relative ones stay, others are dropped."""
    out = F.when(~path.rlike(r"^(/|[A-Za-z]:[\\/])"), path)
    for root in sorted((r.rstrip("/") + "/" for r in roots), key=len, reverse=True):
        out = out.when(F.startswith(path, F.lit(root)), F.substring(path, F.lit(len(root) + 1), F.length(path)))
    return out


def clamp_times(df: DataFrame, columns: list[str], now: str, spans: list[str] = []) -> DataFrame:
    """Times over five minutes ahead of ``now`` and negative spans become null, each with a flag."""
    limit = F.to_timestamp(F.lit(now)) + F.make_dt_interval(secs=F.lit(AHEAD_S))
    bad = {c: F.col(c) > limit for c in columns} | {c: F.col(c) < 0 for c in spans}
    flags = F.array_compact(F.array(*[F.when(b, F.lit(f"DQ-10:{c}")) for c, b in bad.items()]))
    return df.select(*[F.when(~F.coalesce(bad[c], F.lit(False)), F.col(c)).alias(c) if c in bad else F.col(c) for c in df.columns], flags.alias("clock_flags"))


def sheet_faults(df: DataFrame, required: list[str], hours: str, day: str) -> DataFrame:
    """Rows of a report sheet with the list of their faults; a row with faults is kept, never dropped."""
    tests = [F.when(F.coalesce(F.trim(c), F.lit("")) == "", F.lit(f"{c}: missing")) for c in required]
    h = F.col(hours).try_cast("double")
    tests += [F.when(h.isNull() & F.col(hours).isNotNull(), F.lit(f"{hours}: no number")).when((h < 0) | (h > 24), F.lit(f"{hours}: out of range"))]
    tests += [F.when(F.col(day).isNotNull() & F.try_to_date(day, "yyyy-MM-dd").isNull(), F.lit(f"{day}: no date"))]
    return df.withColumn("faults", F.array_compact(F.array(*tests)))


def admit(df: DataFrame, now: str, allowed: dict[str, list[str]] | None = None) -> DataFrame:
    """Flat events with ``reject``, ``dq_flags`` and, where accepted, cleaned fields.

    event_time ahead of ``now`` by over five minutes, or unreadable, becomes
    now; values outside the closed lists become null; attributes that the
    type's list doesn't have are stripped. Each change leaves a flag.
    """
    at = F.to_timestamp(F.lit(now))
    out = df if "event_time_text" in df.columns else df.withColumn("event_time_text", F.col("event_time").cast("string"))
    out = out.withColumn("reject", reject_reason(out))
    bad_time = F.col("event_time").isNull() | (F.col("event_time") > at + F.make_dt_interval(secs=F.lit(AHEAD_S)))
    flags = [F.when(bad_time, F.lit("DQ-10:event_time"))]
    flags += [F.when(F.col(c).isNotNull() & ~F.col(c).isin(*v), F.lit(f"DQ-15:{c}")) for c, v in ENUMS.items() if c in df.columns]
    if allowed is not None:
        names = F.create_map(*[x for k, v in allowed.items() for x in (F.lit(k), F.array(*[F.lit(y) for y in v]))])
        known = F.coalesce(names[F.col("event_type")], F.array().cast("array<string>"))
        extra = F.array_except(top_keys("attributes"), known)
        kept = F.map_filter(F.from_json("attributes", "map<string,string>"), lambda k, _: F.array_contains(known, k))
        out = out.withColumn("_extra", extra).withColumn("attributes", F.when(F.size(extra) > 0, F.to_json(kept)).otherwise(F.col("attributes")))
        flags.append(F.when(F.size("_extra") > 0, F.concat(F.lit("stripped:"), F.array_join(F.array_sort("_extra"), ","))))
    out = out.withColumn("dq_flags", F.array_compact(F.array(*flags))).withColumn("event_time", F.when(bad_time, at).otherwise(F.col("event_time")))
    for c, v in ENUMS.items():
        if c in df.columns:
            out = out.withColumn(c, F.when(F.col(c).isin(*v), F.col(c)))
    return out.withColumn("ingested_at", at).drop("_extra", "event_time_text")
