"""The telemetry queries: one plan text a query, in either dialect.

``queries()`` runs the Spark form over a folder of Parquet tables;
``oracle_sql()`` is the DuckDB form. Relations that a plan reads more than once
are cached (memory, then disk) and found again by later plans over the same
folder; the KEPT last used ones stay, older ones and other folders' are let go.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .dialect import DUCK, SPARK, Spark
from .relations import EVENTS_AS_OF, ORDERS_AS_OF, chain, parts

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "conversations", "labels", "benchmark")
PLANS: dict[str, Callable[[Spark], str]] = {}


def plan(f: Callable[[Spark], str]) -> Callable[[Spark], str]:
    PLANS[f.__name__] = f
    return f


#: Relations worth keeping when a plan reads them more than once.
SHARED = ("ev", "runs", "priced", "outputs", "fct_run", "fct_output")
KEPT = 6
#: Plans that take few columns of a relation and read it anew: kept whole it would cost them more disk.
ANEW = {"m03_cost_per_accepted": ("ev",)}
_kept: dict[tuple[str, str], DataFrame] = {}


def _keep(df: DataFrame, sf_dir: str, name: str) -> None:
    """Cache a relation; the least recently used beyond KEPT, and those of other folders, go."""
    _kept.pop((sf_dir, name), None)
    _kept[(sf_dir, name)] = df.persist()
    for key in [k for k in _kept if k[0] != sf_dir] + list(_kept)[: max(0, len(_kept) - KEPT)]:
        old = _kept.pop(key, None)
        if old is not None and old.sparkSession is df.sparkSession:
            old.unpersist()


def runner(f: Callable[[Spark], str]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        body = f(SPARK)
        needed = parts(SPARK, body)
        text = "\n".join([*needed.values(), body])
        for t in TABLES:
            if t in text:
                spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
        refer = re.compile(rf"\b(FROM|JOIN)\s+({'|'.join(needed)})\b") if needed else None
        named = lambda sql: refer.sub(r"\1 telemetry_\2", sql) if refer else sql
        for name, sql in needed.items():
            df = spark.sql(named(sql))
            # Each reference prunes columns its own way, so Spark wouldn't reuse the
            # shuffles below; cached once, they are read from there.
            if name in SHARED and name not in ANEW.get(f.__name__, ()) and len(re.findall(rf"\b(?:FROM|JOIN)\s+{name}\b", text)) > 1:
                _keep(df, sf_dir, name)
            df.createOrReplaceTempView(f"telemetry_{name}")
        return spark.sql(named(body))

    run.__name__, run.__doc__ = f.__name__, f.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: runner(f) for name, f in PLANS.items()}


def oracle_sql() -> dict[str, str]:
    return {name: chain(DUCK, f(DUCK)) for name, f in PLANS.items()}


def k_guard(n: str, value: str, k: int = 5) -> str:
    """A rate over fewer than k members is not shown."""
    return f"CASE WHEN {n} >= {k} THEN {value} END"


def rate(part: str, whole: str) -> str:
    return f"100.0 * ({part}) / nullif({whole}, 0)"


# ---- ingest, deduplication, sources -------------------------------------------------


@plan
def m10_tool_error_rate(d: Spark) -> str:
    """Tool errors by day and tool over calls with a known status; small groups hidden."""
    return f"""
SELECT {d.day('event_time')} AS day, tool_name, count(*) AS calls, count(status) AS known, {d.big("count_if(status = 'error')")} AS errors_seen,
  CASE WHEN count(status) > 0 THEN {d.big("count_if(status = 'error')")} END AS errors,
  CAST({k_guard('count(status)', rate("count_if(status = 'error')", 'count(status)'))} AS DOUBLE) AS error_rate, {d.joined('tool_kind', 3)} AS kinds
FROM tools GROUP BY {d.day('event_time')}, tool_name"""


@plan
def s01_partition_scan(d: Spark) -> str:
    """Events of the trailing 21 days, by day."""
    return f"SELECT {d.day('ts')} AS day, count(*) AS n FROM events WHERE ts >= {d.ts(EVENTS_AS_OF)} - {d.days('21')} AND ts < {d.ts(EVENTS_AS_OF)} GROUP BY {d.day('ts')}"


@plan
def w01_dedup_keep_first(d: Spark) -> str:
    """Of the deliveries of one event_id the earliest by arrival stays."""
    return "SELECT event_id, event_time, ingested_at, run_id, event_type FROM ev"


@plan
def r06_lateness(d: Spark) -> str:
    """Events that arrive over seven days late, model calls exempt."""
    return f"""
SELECT event_type, {d.diff('DAY', 'event_time', 'ingested_at')} AS days_late, count(*) AS n FROM ev
WHERE event_type <> 'model.call' AND {d.diff('SECOND', 'event_time', 'ingested_at')} > 7 * 86400 GROUP BY event_type, {d.diff('DAY', 'event_time', 'ingested_at')}"""


@plan
def i02_secret_screen(d: Spark) -> str:
    """Texts that hold what looks like a secret, by pattern; only names leave the screen."""
    pats = {"aws_key": "AKIA[0-9A-Z]{16}", "private_key": "-----BEGIN [A-Z ]*PRIVATE KEY-----", "token": "(ghp|gho|xoxb|xoxp)[_-][A-Za-z0-9]{16,}", "bearer": "[Bb]earer [A-Za-z0-9._-]{20,}", "assignment": "(?i)(password|secret|api_key)[ ]*[:=][ ]*[^ ]{8,}", "jwt": "eyJ[A-Za-z0-9_-]{10,}[.][A-Za-z0-9_-]{10,}", "hex40": "[^0-9a-f][0-9a-f]{40}[^0-9a-f]"}
    return " UNION ALL ".join(f"SELECT '{k}' AS check_name, {d.big(f'''count_if({d.like_re('text', v)})''')} AS hits, count(*) AS screened FROM documents" for k, v in pats.items())


@plan
def i03_email_screen(d: Spark) -> str:
    """Documents with a raw e-mail address."""
    return f"SELECT doc_id, source FROM documents WHERE {d.like_re('text', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+[.][A-Za-z]{2,}')}"


@plan
def i10_enum_to_null(d: Spark) -> str:
    """Values outside the closed list become null and leave a flag."""
    return """
SELECT surface_ok AS surface, flag, count(*) AS n FROM (
  SELECT CASE WHEN surface IN ('copilot-cli', 'vscode-copilot-chat') THEN surface END AS surface_ok,
         CASE WHEN surface NOT IN ('copilot-cli', 'vscode-copilot-chat') THEN 'DQ-15:surface' END AS flag FROM ev) AS x GROUP BY surface_ok, flag"""


@plan
def i11_clock_clamps(d: Spark) -> str:
    """Times ahead of the clock are set to it, ends before starts to the start; each is flagged."""
    now = d.ts("2024-01-25 00:00:00")
    late = f"event_time > {now} + {d.hours('1')}"
    return f"""
SELECT event_id, CASE WHEN {late} THEN {now} ELSE event_time END AS event_time, CASE WHEN ended < event_time THEN event_time ELSE ended END AS ended_at,
  {late} AS future, ended < event_time AS backwards
FROM (SELECT *, event_time + {d.hours('k % 5 - 1')} AS ended FROM ev) AS x"""


@plan
def i13_envelope_validity(d: Spark) -> str:
    """Envelopes that keep the rules: known type, known link, explicit links at confidence 1."""
    return f"""
SELECT event_type, link_method, {d.big('count_if(ok)')} AS valid, {d.big('count_if(NOT ok)')} AS invalid FROM (
  SELECT event_type, link_method, event_type IN ('run.started', 'tool.call', 'human.turn', 'model.call', 'gate.evaluated') AND link_method IN ('explicit', 'heuristic', 'none')
    AND (link_method <> 'explicit' OR user_id % 5 <> 0) AND n % 97 <> 0 AS ok FROM ev) AS x GROUP BY event_type, link_method"""


# ---- scalar functions ------------------------------------------------------------------


@plan
def f12_period_grains(d: Spark) -> str:
    """Day, Monday week, month and ISO week label of events."""
    return f"SELECT {d.week('event_time')} AS week, {d.month('event_time')} AS month, {d.iso_week('event_time')} AS iso_week, count(*) AS n FROM ev GROUP BY 1, 2, 3"


@plan
def f15_elapsed_units(d: Spark) -> str:
    """Whole elapsed units between creation and merge."""
    return f"SELECT pr_id, {d.diff('DAY', 'created_on', 'merged_at')} AS days, {d.diff('HOUR', 'created_on', 'merged_at')} AS hours, {d.diff('SECOND', 'created_on', 'first_review_at')} AS review_s FROM prs"


@plan
def f30_key_extraction(d: Spark) -> str:
    """The first allow-listed issue key in a text; test-case keys are masked first."""
    extract = "regexp_extract(regexp_replace(t, '[A-Z]+-(TC|CY)-[0-9]+', ' '%s), '(?:^|[^A-Za-z0-9_-])((?:IML|PRJ)-[0-9]+)', 1)" % (", 'g'" if d.name == "duck" else "")
    text = "concat_ws(' ', 'fix', CASE o_orderkey % 5 WHEN 0 THEN concat('IML-TC-', o_orderkey % 90, ' blocks IML-', o_orderkey % 70) WHEN 1 THEN concat('AUG-', o_orderkey % 28) WHEN 2 THEN concat('PRJ-', o_custkey % 40, ' and IML-1') WHEN 3 THEN concat('xIML-', o_custkey) ELSE 'nothing' END)"
    return f"SELECT issue_key, split_part(issue_key, '-', 1) AS project_key, count(*) AS n FROM (SELECT nullif({extract}, '') AS issue_key FROM (SELECT {text} AS t FROM orders) AS a) AS b GROUP BY issue_key"


@plan
def f33_commit_marker(d: Spark) -> str:
    """Marker in the first line only, bounded on both sides, any case."""
    msg = "concat(CASE o_orderkey % 4 WHEN 0 THEN 'feat [AI] add' WHEN 1 THEN 'mAIn branch' WHEN 2 THEN 'ai: rename' ELSE 'plain' END, chr(10), CASE WHEN o_orderkey % 3 = 0 THEN 'AI' ELSE '' END)"
    hit = d.like_re("split_part(m, chr(10), 1)", "(?i)(^|[^A-Za-z0-9_])ai([^A-Za-z0-9_]|$)")
    return f"SELECT marked, count(*) AS n FROM (SELECT {hit} AS marked FROM (SELECT {msg} AS m FROM orders) AS a) AS b GROUP BY marked"


@plan
def f37_path_kind(d: Spark) -> str:
    """File path to automation kind: the first pattern that fits."""
    path = "concat(CASE o_orderkey % 6 WHEN 0 THEN 'features/a.feature' WHEN 1 THEN 'steps/login_steps.py' WHEN 2 THEN 'e2e/cart.spec.ts' WHEN 3 THEN 'pages/home.page.ts' WHEN 4 THEN 'fixtures/user.json' ELSE 'src/main.go' END)"
    kinds = [("feature", "[.]feature$"), ("step_definition", "steps?/|_steps[.]"), ("spec", "[.](spec|test)[.]"), ("page_object", "[.]page[.]"), ("fixture", "fixtures?/")]
    case = " ".join(f"WHEN {d.like_re('p', r)} THEN '{k}'" for k, r in kinds)
    return f"SELECT CASE {case} END AS kind, count(*) AS n FROM (SELECT {path} AS p FROM orders) AS x GROUP BY 1"


@plan
def f44_email_hash(d: Spark) -> str:
    """Salted hash of the trimmed lower-case address; null if the address or salt is missing."""
    return f"SELECT c_custkey, CASE WHEN mail IS NOT NULL THEN {d.sha256("concat('salt', lower(trim(mail)))")} END AS mail_hash FROM (SELECT c_custkey, CASE WHEN c_custkey % 6 <> 0 THEN concat(' ', c_name, '@Example.com ') END AS mail FROM customer) AS x"


@plan
def f45_deterministic_id(d: Spark) -> str:
    """An id from its parts: the same parts give the same id."""
    return f"SELECT n, concat('evt_', substr({d.sha256("concat_ws(chr(31), person_id, event_type, coalesce(skill_name, ''), k)")}, 1, 32)) AS derived_id FROM ev"


@plan
def f49_name_collisions(d: Spark) -> str:
    """Supplier names at most two edits apart, met within blocks of nation and name length.

    In Spark each name of a nation is compared once, however many suppliers have it: two names
    of one length within two edits share what is left without some two letters of each (of a run of one letter its first), long ones (over
    40 letters, as such keys grow with the square) a third that lies a letter away at most. The distance
    decides; then names become suppliers again. Joins are sorted shuffles, as keys are sized too low.
    """
    if d.name == "spark":
        own = "xxhash64(nation, n, k, substr(name, cast(n * k div 3 as int) + 1, cast(n * (k + 1) div 3 as int) - cast(n * k div 3 as int)))"
        placed = "xxhash64(nation, n, k, substr(name, cast(n * k div 3 as int) + 1 + shift, cast(n * (k + 1) div 3 as int) - cast(n * k div 3 as int)))"
        met = "a.key = b.key AND a.nation = b.nation AND length(a.name) = length(b.name) AND levenshtein(a.name, b.name, 2) >= 0"
        return f"""
WITH each_name AS (SELECT s_nationkey AS nation, s_name AS name, length(s_name) AS n FROM supplier WHERE s_nationkey IS NOT NULL AND s_name IS NOT NULL GROUP BY s_nationkey, s_name),
left_over AS (SELECT nation, name, xxhash64(nation, n, concat(substr(name, 1, i - 1), substr(name, i + 1, j - i - 1), substr(name, j + 1))) AS key
  FROM (SELECT *, explode(sequence(i + 1, greatest(n, 2))) AS j FROM (SELECT *, explode(sequence(1, greatest(n - 1, 1))) AS i FROM each_name WHERE n <= 40) AS x) AS y
  WHERE (i = 1 OR substr(name, i, 1) <> substr(name, i - 1, 1)) AND (j = i + 1 OR substr(name, j, 1) <> substr(name, j - 1, 1))),
third AS (SELECT *, explode(array(0, 1, 2)) AS k FROM each_name WHERE n > 40),
near AS (SELECT nation, x, y FROM (
    SELECT /*+ MERGE(b) */ a.nation, a.name AS x, b.name AS y FROM left_over a JOIN left_over b ON {met} AND a.name < b.name
    UNION ALL SELECT /*+ MERGE(b) */ a.nation, least(a.name, b.name), greatest(a.name, b.name) FROM (SELECT nation, name, {own} AS key FROM third) a
      JOIN (SELECT nation, name, {placed} AS key FROM (SELECT *, explode(array(-1, 0, 1)) AS shift FROM third) AS z WHERE n * k div 3 + shift >= 0) b ON {met} AND a.name <> b.name) AS m GROUP BY nation, x, y
  UNION ALL SELECT nation, name, name FROM each_name)
SELECT /*+ MERGE(a, b) */ least(a.s_suppkey, b.s_suppkey) AS a_key, greatest(a.s_suppkey, b.s_suppkey) AS b_key, {d.big('levenshtein(x, y)')} AS edits
FROM near JOIN supplier a ON a.s_nationkey = nation AND a.s_name = x JOIN supplier b ON b.s_nationkey = nation AND b.s_name = y
WHERE a.s_suppkey < b.s_suppkey OR x <> y AND a.s_suppkey > b.s_suppkey"""
    return f"""
SELECT a.s_suppkey AS a_key, b.s_suppkey AS b_key, {d.big('levenshtein(a.s_name, b.s_name)')} AS edits FROM supplier a JOIN supplier b
  ON a.s_nationkey = b.s_nationkey AND length(a.s_name) = length(b.s_name) AND a.s_suppkey < b.s_suppkey WHERE levenshtein(a.s_name, b.s_name) <= 2"""


# ---- joins --------------------------------------------------------------------------------


@plan
def j06_effective_price(d: Spark) -> str:
    """Calls priced at the rate of their date; null where no price is known."""
    return "SELECT event_id, model_id, tokens_in, tokens_out, tokens_cached, has_price, placeholder, cost_nano FROM priced"


@plan
def j08_as_of(d: Spark) -> str:
    """The last run start of a person at or before each tool call; null before the first."""
    order = "ORDER BY event_time, is_call, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    last = f"last_value(started IGNORE NULLS) OVER (PARTITION BY person_id {order})" if d.name == "duck" else f"last_value(started, true) OVER (PARTITION BY person_id {order})"
    return f"""
SELECT event_id, as_of_start FROM (
  SELECT event_id, is_call, {last} AS as_of_start FROM (
    SELECT event_id, person_id, event_time, 1 AS is_call, CAST(NULL AS TIMESTAMP{'_NTZ' if d.name == 'spark' else ''}) AS started FROM ev WHERE event_type = 'tool.call'
    UNION ALL SELECT event_id, person_id, event_time, 0, event_time FROM ev WHERE event_type = 'run.started') AS a) AS b WHERE is_call = 1"""


@plan
def j09_null_safe_full_join(d: Spark) -> str:
    """Runs and tool calls by agent and skill, both sides kept, null keys equal."""
    return """
SELECT coalesce(a.agent_name, b.agent_name) AS agent_name, coalesce(a.skill_name, b.skill_name) AS skill_name, a.n_runs, b.n_calls
FROM (SELECT agent_name, skill_name, count(*) AS n_runs FROM runs WHERE surface <> 'copilot-cli' GROUP BY agent_name, skill_name) a
FULL OUTER JOIN (SELECT agent_name, skill_name, count(*) AS n_calls FROM tools WHERE surface <> 'vscode-copilot-chat' GROUP BY agent_name, skill_name) b
  ON a.agent_name IS NOT DISTINCT FROM b.agent_name AND a.skill_name IS NOT DISTINCT FROM b.skill_name"""


@plan
def j13_unpriced_models(d: Spark) -> str:
    """Models without a price on the day of the call (anti join on dates)."""
    return """
SELECT c.model_id, c.call_date, count(*) AS calls FROM calls c
WHERE NOT EXISTS (SELECT 1 FROM prices p WHERE p.model_id = c.model_id AND c.call_date BETWEEN p.effective_from AND coalesce(p.effective_to, DATE '9999-12-31'))
GROUP BY c.model_id, c.call_date"""


@plan
def j20_tolerance_match(d: Spark) -> str:
    """Reported days matched with trail days of the same person at most one day apart."""
    return f"""
SELECT r.person_id, r.dy, count(t.dy) AS trail_days, CASE WHEN count(t.dy) > 0 THEN 'corroborated' ELSE 'reported_only' END AS outcome
FROM (SELECT DISTINCT person_id, {d.day('event_time')} AS dy FROM turns) r
LEFT JOIN (SELECT DISTINCT person_id, {d.day('event_time')} AS dy, o FROM tools, (VALUES (-1), (0), (1)) AS s(o) WHERE status = 'error') t
  ON r.person_id = t.person_id AND r.dy = {"t.dy + CAST(t.o AS INTEGER)" if d.name == "duck" else "date_add(t.dy, t.o)"} GROUP BY r.person_id, r.dy"""


@plan
def j22_roster_difference(d: Spark) -> str:
    """People missing from the trail, and people in it that no roster has."""
    return """
SELECT 'missing' AS side, c_custkey AS id FROM customer WHERE NOT EXISTS (SELECT 1 FROM ev e WHERE e.user_id = customer.c_custkey)
UNION ALL SELECT 'unexpected', u.user_id FROM (SELECT DISTINCT user_id FROM ev) u WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = u.user_id AND c.c_mktsegment <> 'MACHINERY')"""


# ---- aggregates ---------------------------------------------------------------------------


@plan
def a13_ordered_attempts(d: Spark) -> str:
    """First and last verdict of each run and gate by attempt and time."""
    key = "struct(attempt, event_time, event_id)" if d.name == "spark" else "row(attempt, event_time, event_id)"
    return f"SELECT run_id, gate_name, count(*) AS attempts, {d.low('gate_name', key)} AS name_at_first, {d.top('event_id', key)} AS last_event, {d.low('event_id', key)} AS first_event FROM gates GROUP BY run_id, gate_name"


@plan
def a14_modal_model(d: Spark) -> str:
    """The most used model of each session; ties go to the smaller name."""
    return "SELECT trace_id, model_id, c FROM (SELECT trace_id, model_id, c, row_number() OVER (PARTITION BY trace_id ORDER BY c DESC, model_id) AS nth FROM (SELECT trace_id, model_id, count(*) AS c FROM calls GROUP BY trace_id, model_id) AS a) AS b WHERE nth = 1"


@plan
def a15_quantiles(d: Spark) -> str:
    """Median and 85th percentile as observed values."""
    return f"SELECT event_type, {d.disc(0.5, 'value')} AS p50, {d.disc(0.85, 'value')} AS p85, count(*) AS n FROM ev GROUP BY event_type"


@plan
def a16_distinct_names(d: Spark) -> str:
    return f"SELECT surface, {d.joined('agent_name')} AS agents, {d.joined('skill_name', 2)} AS first_skills, count(DISTINCT person_id) AS people FROM ev GROUP BY surface"


@plan
def a20_unknown_aware_verdicts(d: Spark) -> str:
    return "SELECT run_id, gates, passed, failed, unknown, retries FROM gate_rollup"


@plan
def a21_unanimous(d: Spark) -> str:
    """A dimension's value where all of a session's calls agree, else null."""
    return f"SELECT trace_id, CASE WHEN count(DISTINCT model_id) = 1 THEN max(model_id) END AS model_id, CASE WHEN count(DISTINCT run_id) = 1 THEN max(run_id) END AS run_id, {d.big('sum(tokens_in)')} AS tokens_in FROM calls GROUP BY trace_id"


@plan
def a23_cardinalities(d: Spark) -> str:
    """Distinct values of every bounded dimension."""
    dims = ("person_id", "agent_name", "skill_name", "surface", "link_method", "event_type")
    one = "SELECT " + ", ".join(f"count(DISTINCT {c}) AS {c}" for c in dims) + " FROM ev"
    pick = " ".join(f"WHEN '{c}' THEN {c}" for c in dims)
    return f"SELECT v.dim, CASE v.dim {pick} END AS n FROM ({one}) AS a CROSS JOIN (VALUES {', '.join(f'''('{c}')''' for c in dims)}) AS v(dim)"


@plan
def a27_exact_median(d: Spark) -> str:
    return "SELECT repo, median(CAST(n AS DOUBLE)) AS median_outputs FROM (SELECT p.repo, p.pr_id, count(o.output_id) AS n FROM prs p LEFT JOIN outputs o ON p.pr_id = o.pr_id GROUP BY p.repo, p.pr_id) AS a GROUP BY repo"


@plan
def a28_nearest_rank(d: Spark) -> str:
    """Nearest-rank percentile with half-even rounding of the rank."""
    even = "CASE WHEN x - floor(x) = 0.5 AND CAST(floor(x) AS BIGINT) % 2 = 0 THEN floor(x) ELSE floor(x + 0.5) END"
    return f"""
SELECT repo, min(v) AS p85 FROM (SELECT repo, v, row_number() OVER (PARTITION BY repo ORDER BY v, pr_id) - 1 AS i, 0.85e0 * (count(*) OVER (PARTITION BY repo) - 1) AS x
  FROM (SELECT repo, pr_id, {d.diff('HOUR', 'created_on', 'merged_at')} AS v FROM prs WHERE merged_at IS NOT NULL) AS a) AS b WHERE i = {even} GROUP BY repo"""


@plan
def a29_latest_snapshot(d: Spark) -> str:
    """Stock, not flow: the last known state of each person, counted."""
    return "SELECT event_type, count(*) AS people FROM (SELECT person_id, event_type, row_number() OVER (PARTITION BY person_id ORDER BY event_time DESC, n DESC) AS nth FROM ev) AS a WHERE nth = 1 GROUP BY event_type"


@plan
def a32_median_of_shares(d: Spark) -> str:
    """The median over sessions of the cached share, not the share of sums."""
    return "SELECT surface, median(share) AS cached_share, count(*) AS sessions FROM (SELECT surface, trace_id, sum(tokens_cached) * 1e0 / nullif(sum(tokens_in), 0) AS share FROM calls GROUP BY surface, trace_id) AS a GROUP BY surface"


@plan
def a34_modelled_cost(d: Spark) -> str:
    """Measured cost plus the median priced call for each call without a price."""
    return f"SELECT surface, {d.big('sum(cost_nano)')} AS measured_nano, {d.big('count_if(cost_nano IS NULL)')} AS unpriced, {d.big(d.disc(0.5, 'cost_nano'))} AS median_nano, {d.big('sum(cost_nano)')} + {d.big('count_if(cost_nano IS NULL)')} * {d.big(d.disc(0.5, 'cost_nano'))} AS modelled_nano FROM priced GROUP BY surface"


# ---- windows, sorts, sets -------------------------------------------------------------------


@plan
def w08_lag_jump(d: Spark) -> str:
    """Day-on-day change of calls by tool, where it passes 30 percent."""
    return f"""
SELECT tool_name, day, n, before FROM (SELECT tool_name, day, n, lag(n) OVER (PARTITION BY tool_name ORDER BY day) AS before
  FROM (SELECT tool_name, {d.day('event_time')} AS day, count(*) AS n FROM tools GROUP BY tool_name, {d.day('event_time')}) AS a) AS b WHERE abs(n - before) * 10 > 3 * before"""


@plan
def w09_share_in_month(d: Spark) -> str:
    return f"SELECT mon, agent_name, n, CAST(sum(n) OVER (PARTITION BY mon) AS BIGINT) AS month_total FROM (SELECT {d.month('event_time')} AS mon, agent_name, count(*) AS n FROM ev GROUP BY {d.month('event_time')}, agent_name) AS a"


@plan
def w10_first_fix(d: Spark) -> str:
    """The first fail that a pass follows, of each run and gate."""
    return """
SELECT run_id, gate_name, event_id FROM (
  SELECT run_id, gate_name, event_id, row_number() OVER (PARTITION BY run_id, gate_name ORDER BY event_time, event_id) AS nth FROM (
    SELECT run_id, gate_name, event_id, event_time, verdict, lag(verdict) OVER (PARTITION BY run_id, gate_name ORDER BY event_time, event_id) AS before FROM gates) AS a WHERE verdict = 'pass' AND before = 'fail') AS b WHERE nth = 1"""


@plan
def w11_trend_class(d: Spark) -> str:
    """A person's weekly activity as rising, falling, flat or mixed by the signs of its steps."""
    return f"""
SELECT person_id, count(*) AS weeks, CASE WHEN {d.big('count_if(step > 0)')} > 0 AND {d.big('count_if(step < 0)')} > 0 THEN 'mixed' WHEN {d.big('count_if(step > 0)')} > 0 THEN 'rising' WHEN {d.big('count_if(step < 0)')} > 0 THEN 'falling' ELSE 'flat' END AS trend
FROM (SELECT person_id, wk, n - lag(n) OVER (PARTITION BY person_id ORDER BY wk) AS step FROM (SELECT person_id, {d.week('event_time')} AS wk, count(*) AS n FROM ev GROUP BY person_id, {d.week('event_time')}) AS a) AS b GROUP BY person_id"""


@plan
def w12_attempt_index(d: Spark) -> str:
    return f"SELECT event_id, {d.big('row_number() OVER (PARTITION BY trace_id, gate_name ORDER BY event_time, event_id) - 1')} AS attempt_index FROM gates"


@plan
def w14_retry_depth(d: Spark) -> str:
    """Attempts before the first pass of each session and gate."""
    return f"""
SELECT trace_id, gate_name, {d.big('min(i)')} AS depth FROM (SELECT trace_id, gate_name, verdict, row_number() OVER (PARTITION BY trace_id, gate_name ORDER BY event_time, event_id) - 1 AS i FROM gates) AS a WHERE verdict = 'pass' GROUP BY trace_id, gate_name"""


@plan
def t03_top_agents(d: Spark) -> str:
    return f"SELECT agent_name, skill_name, count(*) AS n_runs FROM runs GROUP BY agent_name, skill_name ORDER BY n_runs DESC, agent_name, skill_name NULLS LAST LIMIT 10"


@plan
def u03_set_algebra(d: Spark) -> str:
    """People on one surface only, on both, on any."""
    one, two = "SELECT DISTINCT user_id FROM ev WHERE event_type = 'tool.call' AND k < 50", "SELECT DISTINCT user_id FROM ev WHERE event_type = 'gate.evaluated' AND k > 90"
    return f"SELECT 'both' AS part, count(*) AS n FROM ({one} INTERSECT {two}) AS a UNION ALL SELECT 'first_only', count(*) FROM ({one} EXCEPT {two}) AS b UNION ALL SELECT 'any', count(*) FROM ({one} UNION {two}) AS c"


# ---- facts --------------------------------------------------------------------------------------


@plan
def x14_session_usage(d: Spark) -> str:
    return "SELECT trace_id, calls, tokens_in, tokens_out, tokens_cached, cost_nano, has_unpriced, has_placeholder FROM usage"


@plan
def x26_run_fact(d: Spark) -> str:
    return "SELECT * FROM fct_run"


@plan
def x32_output_claims(d: Spark) -> str:
    return "SELECT output_id, pr_id, l_suppkey, lines_added, reused, quarantined, committed_at FROM outputs"


@plan
def x40_pr_rework(d: Spark) -> str:
    return "SELECT pr_id, n_outputs, generated, after_review, after_review * 1e0 / nullif(generated, 0) AS ratio FROM rework"


@plan
def x43_output_states(d: Spark) -> str:
    """Outputs with their acceptance state and the reason for it."""
    return "SELECT output_id, pr_id, acceptance_reason, acceptance_state, lines_added FROM fct_output"


@plan
def x60_pull_requests(d: Spark) -> str:
    return "SELECT pr_id, repo, author, created_on, first_review_at, merged_at, declined_at, reverted_at, is_draft, is_bot_only FROM prs"


@plan
def x63_test_cases(d: Spark) -> str:
    return "SELECT case_id, automation_status, priority, archived, folder FROM cases"


@plan
def x54_daily_mart(d: Spark) -> str:
    """Runs and outputs by agent with rates hidden under five members."""
    return f"""
SELECT coalesce(a.agent_name, b.agent_name) AS agent_name, a.run_date, a.n_runs, a.people, a.succeeded, a.turns, a.cost_nano, b.outputs, b.accepted,
  CAST({k_guard('a.n_runs', rate('a.succeeded', 'a.terminal_runs'))} AS DOUBLE) AS success_rate, CAST({k_guard('b.terminal_outputs', rate('b.accepted', 'b.terminal_outputs'))} AS DOUBLE) AS acceptance_rate
FROM (SELECT agent_name, run_date, count(*) AS n_runs, count(DISTINCT person_id) AS people, {d.big("count_if(terminal_status = 'success')")} AS succeeded, {d.big("count_if(terminal_status <> 'in_flight')")} AS terminal_runs,
        {d.big('sum(turns)')} AS turns, {d.big('sum(cost_nano)')} AS cost_nano FROM fct_run GROUP BY agent_name, run_date) a
FULL OUTER JOIN (SELECT agent_name, count(*) AS outputs, {d.big("count_if(acceptance_state = 'accepted')")} AS accepted, {d.big("count_if(acceptance_state IN ('accepted', 'reworked', 'rejected'))")} AS terminal_outputs FROM fct_output GROUP BY agent_name) b
  ON a.agent_name IS NOT DISTINCT FROM b.agent_name"""


# ---- metric views ---------------------------------------------------------------------------------


@plan
def m01_acceptance_rate(d: Spark) -> str:
    """Accepted over terminal outputs, at three limits of the rework ratio."""
    base = "acceptance_reason IN ('over_ratio', 'under_ratio', 'ratio_undefined')"
    at = ", ".join(f"CAST({k_guard('terminal', rate(f'at_{p}', 'terminal'))} AS DOUBLE) AS rate_{p}" for p in (10, 25, 50))
    sums = ", ".join(f"{d.big(f'count_if({base} AND coalesce(rework_ratio, 0) <= 0.{p})')} AS at_{p}" for p in (10, 25, 50))
    return f"SELECT agent_name, mon, terminal, at_10, at_25, at_50, {at} FROM (SELECT agent_name, {d.month('created_on')} AS mon, {d.big(f'''count_if({base} OR acceptance_state = 'rejected')''')} AS terminal, {sums} FROM fct_output WHERE NOT quarantined AND NOT reused GROUP BY agent_name, {d.month('created_on')}) AS a"


@plan
def m02_rework_rate(d: Spark) -> str:
    """Rework at the grain of pull requests first, then over a repository."""
    return f"SELECT repo, count(ratio) AS n, {k_guard('count(ratio)', d.disc(0.5, 'ratio'))} AS p50, {k_guard('count(ratio)', d.disc(0.85, 'ratio'))} AS p85 FROM (SELECT p.repo, w.after_review * 1e0 / nullif(w.generated, 0) AS ratio FROM rework w JOIN prs p ON w.pr_id = p.pr_id) AS a GROUP BY repo"


@plan
def m03_cost_per_accepted(d: Spark) -> str:
    """Cost of all runs, those without outputs too, over accepted outputs."""
    runs = "fct_run" if d.name == "duck" else "run_cost"
    return f"""
SELECT coalesce(a.agent_name, b.agent_name) AS agent_name, a.cost_nano, a.n_runs, a.costed, b.accepted, a.cost_nano / 1e9 / nullif(b.accepted, 0) AS cost_per_accepted, CAST({rate('a.costed', 'a.n_runs')} AS DOUBLE) AS cost_complete_pct
FROM (SELECT agent_name, {d.big('sum(cost_nano)')} AS cost_nano, count(*) AS n_runs, count(cost_nano) AS costed FROM {runs} GROUP BY agent_name) a
FULL OUTER JOIN (SELECT agent_name, {d.big("count_if(acceptance_state = 'accepted')")} AS accepted FROM fct_output GROUP BY agent_name) b ON a.agent_name IS NOT DISTINCT FROM b.agent_name"""


@plan
def m04_pr_lead_time(d: Spark) -> str:
    h = d.diff("HOUR", "created_on", "merged_at")
    return f"SELECT repo, count(*) AS n, {d.big(k_guard('count(*)', d.disc(0.5, h)))} AS p50_h, {d.big(k_guard('count(*)', d.disc(0.85, h)))} AS p85_h FROM prs WHERE merged_at IS NOT NULL AND NOT is_draft AND NOT is_bot_only GROUP BY repo"


@plan
def m05_asset_reuse(d: Spark) -> str:
    """Agents and skills that two or more people used in five or more runs."""
    return f"""
SELECT kind, mon, count(*) AS assets, {d.big('count_if(people >= 2 AND n_runs >= 5)')} AS shared, CAST({k_guard('count(*)', rate('count_if(people >= 2 AND n_runs >= 5)', 'count(*)'), 3)} AS DOUBLE) AS reuse_rate
FROM (SELECT 'agent' AS kind, agent_name AS asset, {d.month('started_at')} AS mon, count(DISTINCT person_id) AS people, count(*) AS n_runs FROM runs GROUP BY agent_name, {d.month('started_at')}
  UNION ALL SELECT 'skill', skill_name, {d.month('started_at')}, count(DISTINCT person_id), count(*) FROM runs WHERE skill_name IS NOT NULL GROUP BY skill_name, {d.month('started_at')}) AS a GROUP BY kind, mon"""


@plan
def m07_intervention_rate(d: Spark) -> str:
    """Runs with a correction or rejection; approvals don't count."""
    return f"SELECT agent_name, count(*) AS n, {d.big('count_if(corrections + rejections >= 1)')} AS intervened, CAST({k_guard('count(*)', rate('count_if(corrections + rejections >= 1)', 'count(*)'))} AS DOUBLE) AS intervention_rate FROM fct_run GROUP BY agent_name"


@plan
def m08_automation_coverage(d: Spark) -> str:
    """Automated over all and over cases of known status, live ones."""
    return f"""
SELECT priority, count(*) AS n, {d.big("count_if(automation_status = 'Automated')")} AS automated, {d.big("count_if(automation_status LIKE 'To Be%')")} AS planned, {d.big('count_if(automation_status IS NULL)')} AS unset,
  CAST({rate("count_if(automation_status = 'Automated')", 'count(*)')} AS DOUBLE) AS of_all, CAST({rate("count_if(automation_status = 'Automated')", 'count(automation_status)')} AS DOUBLE) AS of_known FROM cases WHERE NOT archived GROUP BY priority"""


@plan
def m09_run_reliability(d: Spark) -> str:
    return f"""
SELECT agent_name, surface, count(*) AS n, {d.big("count_if(terminal_status = 'success')")} AS succeeded, {d.big("count_if(terminal_status = 'timeout')")} AS timeouts, {d.big('sum(retries)')} AS retries, {d.big('sum(tool_errors)')} AS tool_errors, {d.big('sum(tool_known)')} AS tool_known,
  CAST({k_guard("count_if(terminal_status <> 'in_flight')", rate("count_if(terminal_status = 'success')", "count_if(terminal_status <> 'in_flight')"))} AS DOUBLE) AS success_rate, CAST({k_guard('sum(tool_known)', rate('sum(tool_errors)', 'sum(tool_known)'))} AS DOUBLE) AS tool_error_rate FROM fct_run GROUP BY agent_name, surface"""


@plan
def m11_session_usage(d: Spark) -> str:
    """Usage by session and model with the session's only run, if it has one."""
    return f"SELECT p.trace_id, p.model_id, CASE WHEN min(s.run_count) = 1 THEN min(p.agent_name) END AS agent_name, count(*) AS calls, {d.big('sum(p.tokens_in)')} AS tokens_in, CASE WHEN bool_and(p.cost_nano IS NOT NULL) THEN {d.big('sum(p.cost_nano)')} END AS cost_nano FROM priced p LEFT JOIN sessions s ON p.trace_id = s.trace_id GROUP BY p.trace_id, p.model_id"


@plan
def m12_config_comparison(d: Spark) -> str:
    """Arms of agent, skill and surface with at least 20 runs, against all runs of the agent."""
    return f"""
SELECT a.agent_name, a.skill_name, a.surface, a.n, a.succeeded, b.n AS agent_runs FROM (SELECT agent_name, skill_name, surface, count(*) AS n, {d.big("count_if(terminal_status = 'success')")} AS succeeded FROM fct_run GROUP BY agent_name, skill_name, surface) a
LEFT JOIN (SELECT agent_name, count(*) AS n FROM fct_run GROUP BY agent_name) b ON a.agent_name IS NOT DISTINCT FROM b.agent_name WHERE a.n >= 20"""


# ---- weekly, person and coverage reports ----------------------------------------------------------------


@plan
def g01_event_mix(d: Spark) -> str:
    return f"SELECT {d.iso_week('event_time')} AS iso_week, surface, count(*) AS n, {d.big('count_if(skill_name IS NOT NULL)')} AS with_skill, {d.big('''count_if(link_method = 'explicit')''')} AS explicit_links FROM ev GROUP BY 1, surface"


@plan
def g02_weekly_reach(d: Spark) -> str:
    return f"SELECT {d.iso_week('event_time')} AS iso_week, count(DISTINCT person_id) AS people, count(DISTINCT trace_id) AS sessions, count(DISTINCT skill_name) AS skills, count(DISTINCT agent_name) AS agents FROM ev GROUP BY 1"


@plan
def g05_weekly_tokens(d: Spark) -> str:
    return f"SELECT {d.iso_week('event_time')} AS iso_week, {d.big('sum(tokens_in)')} AS tokens_in, {d.big('sum(tokens_out)')} AS tokens_out, {d.big('sum(tokens_cached)')} AS tokens_cached, count(*) AS requests, count(DISTINCT model_id) AS models, count(DISTINCT CASE WHEN tokens_in IS NOT NULL THEN trace_id END) AS sessions_with_usage, {d.big('sum(cost_nano)')} AS cost_nano FROM priced GROUP BY 1"


@plan
def g07_weekly_tools(d: Spark) -> str:
    return f"SELECT {d.iso_week('event_time')} AS iso_week, tool_kind, {d.big('''count_if(status = 'ok')''')} AS ok, {d.big('''count_if(status <> 'ok')''')} AS failed, {d.big('count_if(status IS NULL)')} AS unknown FROM tools GROUP BY 1, tool_kind"


@plan
def g10_weekly_gates(d: Spark) -> str:
    return f"SELECT {d.iso_week('event_time')} AS iso_week, gate_name, coalesce(verdict, 'unknown') AS verdict, count(*) AS n FROM gates GROUP BY 1, gate_name, coalesce(verdict, 'unknown')"


@plan
def g11_weekly_prs(d: Spark) -> str:
    return f"SELECT {d.iso_week('created_on')} AS iso_week, count(*) AS opened, count(merged_at) AS merged, count(declined_at) AS declined, count(reverted_at) AS reverted, count(first_review_at) AS reviewed FROM prs GROUP BY 1"


@plan
def g14_weekly_rates(d: Spark) -> str:
    return f"SELECT {d.iso_week('started_at')} AS iso_week, count(*) AS n, CAST({k_guard('count(*)', rate('''count_if(terminal_status = 'success')''', '''count_if(terminal_status <> 'in_flight')'''))} AS DOUBLE) AS success_rate, CAST({k_guard('sum(gates)', rate('sum(passed)', 'sum(passed) + sum(failed)'))} AS DOUBLE) AS gate_pass_rate, CAST({rate('count_if(terminal_status = ' + repr('in_flight') + ')', 'count(*)')} AS DOUBLE) AS open_share FROM fct_run GROUP BY 1"


@plan
def h01_person_summary(d: Spark) -> str:
    return f"SELECT p.c_custkey, p.team, p.project, count(x.pr_id) AS prs, count(x.merged_at) AS merged, {d.big('sum(w.generated)')} AS lines FROM people p LEFT JOIN prs x ON p.c_custkey = x.author LEFT JOIN rework w ON x.pr_id = w.pr_id GROUP BY p.c_custkey, p.team, p.project"


@plan
def h06_gap_filled_trend(d: Spark) -> str:
    """Activity by agent and day over a full day spine: zero where nothing happened."""
    return f"""
SELECT a.agent_name, s.day, count(t.event_id) AS n FROM (SELECT DISTINCT agent_name FROM ev) AS a CROSS JOIN (SELECT {d.explode_days(d.date('2024-01-01'), d.date('2024-01-31'))} AS day) AS s
LEFT JOIN (SELECT event_id, agent_name, {d.day('event_time')} AS day FROM tools WHERE status = 'error') AS t ON a.agent_name = t.agent_name AND s.day = t.day GROUP BY a.agent_name, s.day"""


@plan
def h09_estate(d: Spark) -> str:
    return f"SELECT priority, {d.big('''count_if(automation_status = 'Automated')''')} AS automated, {d.big('''count_if(automation_status = 'Manual')''')} AS manual, {d.big('''count_if(automation_status LIKE 'To Be%')''')} AS to_be, {d.big('count_if(automation_status IS NULL)')} AS unset FROM cases GROUP BY priority"


@plan
def h17_activity_index(d: Spark) -> str:
    """Counts by person and day: zero on a day that a machine covered, null on one that none did."""
    return f"""
SELECT s.user_id, s.day, CASE WHEN c.day IS NOT NULL THEN coalesce(t.n, 0) END AS n
FROM (SELECT user_id, day FROM (SELECT DISTINCT user_id FROM ev) AS u CROSS JOIN (SELECT {d.explode_days(d.date('2024-01-01'), d.date('2024-01-31'))} AS day) AS y) AS s
LEFT JOIN (SELECT DISTINCT user_id, {d.day('event_time')} AS day FROM ev) AS c ON s.user_id = c.user_id AND s.day = c.day
LEFT JOIN (SELECT user_id, {d.day('event_time')} AS day, count(*) AS n FROM turns GROUP BY user_id, {d.day('event_time')}) AS t ON s.user_id = t.user_id AND s.day = t.day"""


@plan
def h20_missing_days(d: Spark) -> str:
    """Days without an event inside each person's span."""
    return f"""
SELECT s.user_id, s.day FROM (SELECT user_id, {d.explode_days('a', 'b')} AS day FROM (SELECT user_id, {d.day('min(event_time)')} AS a, {d.day('max(event_time)')} AS b FROM ev GROUP BY user_id) AS r) AS s
WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT user_id, {d.day('event_time')} AS day FROM ev) AS h WHERE h.user_id = s.user_id AND h.day = s.day)"""


@plan
def h24_profile_ranking(d: Spark) -> str:
    """The 25 most active people: the top ones are picked before they are numbered."""
    return f"SELECT person_id, n, rank FROM (SELECT person_id, n, {d.big('row_number() OVER (ORDER BY n DESC, person_id)')} AS rank FROM (SELECT person_id, count(*) AS n FROM ev GROUP BY person_id ORDER BY n DESC, person_id LIMIT 25) AS a) AS b"


@plan
def c01_turns_by_role(d: Spark) -> str:
    """Turns and characters by role in conversations."""
    return f"SELECT role, count(*) AS turns, count(DISTINCT conv_id) AS conversations, {d.big('sum(length(text))')} AS chars, {d.big('max(turn)')} AS deepest FROM conversations GROUP BY role"


from . import derivations, quality, transforms  # noqa: E402, F401  (they add their plans)
