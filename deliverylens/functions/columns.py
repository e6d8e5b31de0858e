"""Column helpers of the telemetry domain. A null means not measured; it never becomes zero."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MIN_GROUP = 5


def k_guard(n: Column, value: Column, k: int = MIN_GROUP) -> Column:
    """``value`` if the group has at least k members."""
    return F.when(n >= k, value)


def rate(part: Column, whole: Column) -> Column:
    """A percentage, null over zero."""
    return F.try_divide(F.lit(100.0) * part, F.nullif(whole, F.lit(0)))


def sum_if_all(value: Column, known: Column) -> Column:
    """Aggregate: the sum if every row is known, else null."""
    return F.when(F.bool_and(known), F.sum(value))


def count_known(status: Column, pred: Column) -> Column:
    """Aggregate: how many rows fit, null if no row has a status."""
    return F.when(F.count(status) > 0, F.count_if(pred))


def unanimous(value: Column) -> Column:
    """Aggregate: the value if all rows that have one agree."""
    return F.when(F.count_distinct(value) == 1, F.max(value))


def price(tokens_in: Column, tokens_out: Column, cached: Column, p_in: Column, p_out: Column, p_cached: Column) -> Column:
    """Cost of a call at rates for 1,000 tokens; null if a part has no count or
    rate. No count of cached tokens means that none were."""
    cached = F.coalesce(cached, F.lit(0))
    fresh = F.when(tokens_in.isNotNull(), F.greatest(tokens_in - cached, F.lit(0)))
    return fresh / 1000 * p_in + tokens_out / 1000 * p_out + F.when(cached == 0, 0).otherwise(cached / 1000 * p_cached)


def iso_week(ts: Column) -> Column:
    return F.concat(F.extract(F.lit("YEAROFWEEK"), ts).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(ts).cast("string"), 2, "0"))


def week_bounds(week: Column) -> tuple[Column, Column]:
    """Monday and Sunday of an ISO week such as 2024-W05: the week that holds 4 January is the first."""
    fourth = F.make_date(F.substring(week, 1, 4).cast("int"), F.lit(1), F.lit(4))
    monday = F.date_add(F.trunc(fourth, "week"), (F.substring(week, 7, 2).cast("int") - 1) * 7)
    return monday, F.date_add(monday, 6)


def month_bounds(month: Column) -> tuple[Column, Column]:
    """First and last day of a month such as 2024-05."""
    first = F.to_date(month, "yyyy-MM")
    return first, F.last_day(first)


def local_day(ts: Column, offset: str = "+07:00") -> Column:
    return F.to_date(F.from_utc_timestamp(ts, offset))


def epoch(n: Column) -> Column:
    """A time from an epoch in seconds or milliseconds, told apart by size."""
    return F.when(F.abs(n) > 100_000_000_000, F.timestamp_millis(n.cast("long"))).otherwise(F.timestamp_seconds(n))


def derived_id(prefix: str, *parts: Column) -> Column:
    joined = F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha2(joined, 256), 1, 32))


def email_hash(address: Column, salt: str | None) -> Column:
    clean = F.lower(F.trim(address))
    return F.lit(None).cast("string") if not salt else F.when(clean != "", F.sha2(F.concat(F.lit(salt), clean), 256))


def issue_key(texts: Sequence[Column], projects: Sequence[str]) -> Column:
    """The first issue key of an allowed project over texts in order; test-case keys are masked."""
    if not projects:
        return F.lit(None).cast("string")

    def first(text: Column) -> Column:
        masked = F.regexp_replace(F.coalesce(text, F.lit("")), r"[A-Z][A-Z0-9]+-(?:TC|CY)-\d+", " ")
        found = F.regexp_extract_all(masked, F.lit(r"(?<![A-Za-z0-9_-])([A-Z][A-Z0-9]+-\d+)(?![A-Za-z0-9_])"), F.lit(1))
        return F.get(F.filter(found, lambda k: F.split_part(k, F.lit("-"), F.lit(1)).isin(*projects)), F.lit(0))

    return F.coalesce(*[first(t) for t in texts])


def test_keys(texts: Sequence[Column], projects: Sequence[str]) -> Column:
    """struct(case_key, cycle_key): the first of each over texts in order, of allowed projects."""

    def first(text: Column, kind: str) -> Column:
        found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"\b([A-Z][A-Z0-9]{{1,9}}-{kind}-\d{{1,7}})\b"), F.lit(1))
        return F.get(F.filter(found, lambda k: F.split_part(k, F.lit("-"), F.lit(1)).isin(*projects)), F.lit(0))

    return F.struct(*[F.coalesce(*[first(t, kind) for t in texts]).alias(name) for kind, name in (("TC", "case_key"), ("CY", "cycle_key"))])


def has_marker(message: Column, marker: str = "AI") -> Column:
    """The marker stands by itself in the first line, in any case."""
    return F.split_part(message, F.lit("\n"), F.lit(1)).rlike(rf"(?i)(?<![A-Za-z0-9_]){marker}(?![A-Za-z0-9_])")


def first_match(text: Column, kinds: dict[str, str], other: str | None = None) -> Column:
    """The name of the first pattern that fits."""
    out = None
    for name, pattern in kinds.items():
        out = F.when(text.rlike(pattern), name) if out is None else out.when(text.rlike(pattern), name)
    return out.otherwise(F.lit(other))


#: Gates by command, error classes by message (the first that fits), kinds of tools by name.
GATES = {
    "test": r"(?i)\b(pytest|jest|vitest|mocha|go\s+test|mvn\s+test|npm\s+(run\s+)?test|yarn\s+test|python\s+-m\s+unittest|playwright\s+test|cucumber)\b",
    "lint": r"(?i)\b(eslint|ruff|flake8|pylint|golangci-lint|npm\s+run\s+lint|prettier\s+--check)\b",
    "build": r"(?i)\b(tsc|npm\s+run\s+build|mvn\s+(package|compile)|gradle\s+build|go\s+build|cargo\s+build|make\b)",
    "coverage": r"(?i)\b(coverage|--cov|nyc|jacoco)\b",
    "secrets": r"(?i)\b(gitleaks|trufflehog|detect-secrets)\b",
}
ERROR_CLASSES = {
    "permission_denied": r"(?i)user permission response|denied",
    "not_found": r"(?i)no match found|does not exist|not found",
    "ambiguous_match": r"(?i)multiple matches",
    "invalid_input": r"(?i)invalid (inputs?|shell id)|is required",
    "timeout": r"(?i)timed? ?out",
}
TOOL_KINDS = {
    "bash": "terminal", "read_bash": "terminal", "write_bash": "terminal", "stop_bash": "terminal", "list_bash": "terminal",
    "view": "file", "edit": "file", "create": "file", "glob": "file", "grep": "file", "web_fetch": "http",
    "sql": "other", "skill": "other", "task": "other", "report_intent": "other", "ask_user": "other",
}


#: Types of artifacts by path (the first that fits, in any case), else code.
ARTIFACT_TYPES = {
    "test": r"(?i)\.feature$|(\.|_)(spec|test)\.(ts|js|tsx|jsx|py)$|(^|/)tests?/|(^|/)test_[^/]+\.py$|[._-]test\.py$|Test\.java$|[._-]steps?\.(ts|js|py|java)$",
    "spec": r"(?i)(^|/)(specs?|requirements?)/.*\.md$|[-_.](spec|specification)\.md$",
    "mock": r"(?i)(^|/)(mocks?|stubs?|fixtures?)/|[._-]mock\.",
    "config": r"(?i)\.(ya?ml|toml|ini|cfg|json|properties)$|(^|/)(Dockerfile|Makefile)$",
    "csv": r"(?i)\.csv$",
    "doc": r"(?i)\.(md|rst|adoc)$",
}


def gate_of(command: Column) -> Column:
    return first_match(command, GATES)


def error_class(message: Column) -> Column:
    return F.when(message.isNotNull(), first_match(message, ERROR_CLASSES, "other"))


def exit_code(output: Column) -> Column:
    """The exit code that the last line of a tool's output states; one printed before it doesn't count."""
    return F.regexp_extract(output, r"<exited with exit code (-?\d+)>\s*$", 1).try_cast("int")


def tool_kind(name: Column, server: Column) -> Column:
    """``mcp`` where a server is named, else the kind of the name."""
    table = F.create_map(*[F.lit(x) for kv in TOOL_KINDS.items() for x in kv])
    return F.when(server.isNotNull(), "mcp").otherwise(F.coalesce(table[name], F.lit("other")))


def build_name(name: Column) -> Column:
    """struct(job, branch, number) of ``job » branch #number``; other names are the job."""
    parts = [F.nullif(F.trim(F.regexp_extract(F.trim(name), r"^(.+?)\s*»\s*(.+?)\s*#(\d+)\s*$", k)), F.lit("")) for k in (1, 2, 3)]
    return F.struct(F.coalesce(parts[0], F.nullif(F.substring(F.trim(name), 1, 200), F.lit(""))).alias("job"), parts[1].alias("branch"), parts[2].alias("number"))


def days_between(a: Column, b: Column) -> Column:
    return F.round((F.unix_micros(b) - F.unix_micros(a)) / 86_400_000_000, 4)


def hours(ms: Column) -> Column:
    """Hours to two places, rounded half to even."""
    return F.bround(ms / 3_600_000, 2)


def shown(value: Column) -> Column:
    """A measurement as text with two places; a missing one is told, never zero."""
    return F.when(value.isNull(), "n/a").otherwise(F.format_string("%.2f", value))


def rfc3339(ts: Column) -> Column:
    """UTC with milliseconds."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def model_name(raw: Column) -> Column:
    """Without a route prefix, versions with a point: ``x/abc-4-5`` is ``abc-4.5``."""
    return F.regexp_replace(F.regexp_replace(raw, r"^.*/", ""), r"-(\d+)-(\d+)$", "-$1.$2")


def program(command: Column) -> Column:
    """The first word of a command if it is a bare program name."""
    word = F.split_part(F.trim(command), F.lit(" "), F.lit(1))
    return F.when((word != "") & ~word.rlike(r"[/\\]") & (F.length(word) <= 40), word)


def nearest_rank(df: DataFrame, keys: list[str], value: str, p: float, name: str) -> DataFrame:
    """(keys, name): the value at the half-even rounded rank of each group.

    No group is put into one task: values are counted, dealt into parts by range
    in their order, and only the parts' totals meet. Nulls have no rank.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_c"))
    parts = counts.repartitionByRange(*keys, value).withColumn("_part", F.spark_partition_id())
    inside = Window.partitionBy(*keys, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = parts.withColumn("_upto", F.sum("_c").over(inside))
    totals = parts.groupBy(*keys, "_part").agg(F.sum("_c").alias("_n"))  # as many rows as parts for a group
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = totals.select(*keys, "_part", before.alias("_before"), F.sum("_n").over(Window.partitionBy(*keys)).alias("_all"))
    rank = F.bround(F.lit(p) * (F.col("_all") - 1)) + 1
    got = parts.join(totals, [*keys, "_part"]).where((F.col("_before") + F.col("_upto") >= rank) & (F.col("_before") + F.col("_upto") - F.col("_c") < rank))
    return got.select(*keys, F.col(value).alias(name))


#: Labels of priorities; a band's bound is its least size in changed lines.
PRIORITIES = {"high": "P1", "medium": "P2", "low": "P3", "lowest": "P4"}
SIZE_BANDS = {"S (<100)": 0, "M (100-499)": 100, "L (500-1999)": 500, "XL (2000+)": 2000}


def priority_label(name: Column) -> Column:
    """``P1 (High)`` for a known name, another name as it is, ``unset`` for none."""
    table = F.create_map(*[F.lit(x) for kv in PRIORITIES.items() for x in kv])
    known = table[F.lower(F.trim(name))]
    return F.when(F.coalesce(name, F.lit("")) == "", "unset").when(known.isNotNull(), F.concat(known, F.lit(" ("), name, F.lit(")"))).otherwise(name)


def size_band(lines: Column) -> Column:
    """The band of a request's changed lines; ``unknown`` if they aren't known."""
    out = F.when(lines.isNull(), "unknown")
    for name, least in sorted(SIZE_BANDS.items(), key=lambda x: -x[1]):
        out = out.when(lines >= least, name)
    return out.otherwise(min(SIZE_BANDS, key=SIZE_BANDS.get))


def trend_word(points: Column) -> Column:
    """Where a series goes: up or down only if no step goes the other way. Points that aren't
    known are left out; under two have no word (``-``), over two a direction holds ``every week``."""
    p = F.filter(points, lambda x: x.isNotNull())
    steps = F.transform(F.sequence(F.lit(2), F.greatest(F.size(p), F.lit(2))), lambda k: F.get(p, k - 1) - F.get(p, k - 2))
    up, down = F.exists(steps, lambda x: x > 0), F.exists(steps, lambda x: x < 0)
    word = F.when(up & down, "no clear trend").when(up, "up").when(down, "down").otherwise("flat")
    return F.when(F.size(p) < 2, "-").when((F.size(p) > 2) & (up != down), F.concat(word, F.lit(" every week"))).otherwise(word)


def trailer(message: Column, name: str) -> Column:
    """The last value of a trailer line of the message, whatever the name's case; null if there is none."""
    return F.try_element_at(F.regexp_extract_all(message, F.lit(rf"(?im)^\s*{name}\s*:\s*(\S.*?)\s*$"), F.lit(1)), F.lit(-1))


def canonical_json(text: Column) -> Column:
    """A JSON object with its names in order and its values as text, so that equal objects are equal texts."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(F.from_json(text, "map<string,string>")))))


def drifted_labels(labels: Column, known: Sequence[str], shape: str) -> Column:
    """Labels of a marker's shape that are none of the known markers: upper-cased, each once, in order."""
    clean = F.transform(F.coalesce(labels, F.array().cast("array<string>")), lambda x: F.upper(F.trim(x)))
    return F.array_sort(F.array_distinct(F.filter(clean, lambda x: (x != "") & ~x.isin(*known) & x.rlike(shape))))
