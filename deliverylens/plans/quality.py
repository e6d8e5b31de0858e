"""Data-quality checks, one plan a check: (check_id, severity, entity_type, entity_id, detail).

Thresholds and severities are the rules' own; clocks are the stored data's.
"""

from __future__ import annotations

from .catalogue import plan
from .derivations import _array, _unnest
from .dialect import Spark
from .relations import EVENTS_AS_OF, ORDERS_AS_OF

#: A day inside the stored orders, for checks of a few days.
COMMITS_AS_OF = "2001-06-15 00:00:00"

#: The price book with what the checks of it look for: a window that overlaps, and a row twice.
_BAD_PRICES = "(SELECT model_id, effective_from, effective_to FROM prices UNION ALL SELECT model_id, effective_from, effective_to FROM prices WHERE model_id = 'm_1' UNION ALL SELECT 'm_2', DATE '2024-01-10', CAST(NULL AS DATE))"
_USAGE = "CASE WHEN tokens_in IS NULL THEN 'none' WHEN run_date < DATE '2024-01-16' OR user_id % 50 = 7 THEN 'otel_span' ELSE 'session_journal' END"
_PATHS = "concat(CASE k % 5 WHEN 0 THEN '/Users/ann/' WHEN 1 THEN '/home/bo/' WHEN 2 THEN 'src/' WHEN 3 THEN 'C:/w/' ELSE '/opt/' END, 'f', k, '.ts')"
_ISSUES = "(SELECT concat('IML-', o_orderkey) AS issue_key, created_on AS created_at, CASE WHEN pr_id % 6 <> 0 THEN first_review_at END AS first_in_progress_at, merged_at AS done_at, pr_id % 5 AS transition_count FROM prs JOIN orders ON pr_id = o_orderkey)"


def _find(d: Spark, check: str, severity: str, entity: str, entity_id: str, detail: str, rest: str) -> str:
    text = "STRING" if d.name == "spark" else "VARCHAR"
    level = severity if " " in severity else f"'{severity}'"
    return f"SELECT '{check}' AS check_id, {level} AS severity, '{entity}' AS entity_type, CAST({entity_id} AS {text}) AS entity_id, {detail} AS detail {rest}"


def _fmt(d: Spark, text: str, *args: str) -> str:
    return f"{'format_string' if d.name == 'spark' else 'printf'}('{text}', {', '.join(args)})"


def _ago(d: Spark, days: int, as_of: str = EVENTS_AS_OF) -> str:
    return f"{d.ts(as_of)} - {d.days(str(days))}"


@plan
def dq01a_shared_alias(d: Spark) -> str:
    """One verified alias of several people: critical."""
    aliases = f"SELECT c_custkey, c_nationkey, {_unnest(d, _array(d, 'lower(c_name)', 'concat(c_mktsegment, c_nationkey % 5)'))} AS alias FROM customer"
    return _find(d, "DQ-1", "critical", "person", "alias", _fmt(d, "%d people (%s)", "count(DISTINCT c_custkey)", d.joined("concat('p_', c_custkey)", 5)), f"FROM ({aliases}) AS a WHERE c_nationkey > 3 GROUP BY alias HAVING count(DISTINCT c_custkey) > 1")


@plan
def dq01b_unresolved_person(d: Spark) -> str:
    """Runs of seven days by a person whom no alias names: high."""
    return _find(d, "DQ-1", "high", "person", "r.person_id", _fmt(d, "%d runs", "count(*)"), f"FROM runs r WHERE r.started_at >= {_ago(d, 7)} AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = r.user_id AND c.c_mktsegment <> 'BUILDING') GROUP BY r.person_id")


@plan
def dq02_open_runs(d: Spark) -> str:
    """Runs without a terminal event after a day, within thirty."""
    hours = d.diff("HOUR", "started_at", d.ts(EVENTS_AS_OF))
    return _find(d, "DQ-2", "medium", "run", "run_id", _fmt(d, "%d hours, agent %s, surface %s", hours, "coalesce(agent_name, 'unknown')", "coalesce(surface, 'unknown')"), f"FROM fct_run WHERE terminal_status = 'in_flight' AND started_at < {_ago(d, 1)} AND started_at >= {_ago(d, 30)}")


@plan
def dq03_never_committed(d: Spark) -> str:
    """Outputs without a commit a week after they were made, within two; reused ones are exempt."""
    a = COMMITS_AS_OF
    return _find(d, "DQ-3", "low", "output", "o.output_id", _fmt(d, "agent %s", "coalesce(o.agent_name, 'unknown')"), f"FROM outputs o JOIN prs p ON o.pr_id = p.pr_id WHERE (o.committed_at > {d.ts(a)} OR o.l_partkey % 3 = 0) AND NOT coalesce(o.reused, false) AND p.created_on < {_ago(d, 7, a)} AND p.created_on >= {_ago(d, 14, a)}")


@plan
def dq04_marker_only_commits(d: Spark) -> str:
    """Commits of two days that carry the marker and nothing else that links them."""
    link = "CASE l_partkey % 4 WHEN 0 THEN 'explicit' WHEN 1 THEN 'heuristic' WHEN 2 THEN 'marker_only' END"
    return _find(d, "DQ-4", "medium", "commit", "output_id", _fmt(d, "link %s", "coalesce(link, 'null')"), f"FROM (SELECT output_id, committed_at, l_suppkey % 3 <> 0 AS marked, {link} AS link FROM outputs) AS c WHERE marked IS TRUE AND coalesce(link, 'marker_only') = 'marker_only' AND committed_at BETWEEN {_ago(d, 2, COMMITS_AS_OF)} AND {d.ts(COMMITS_AS_OF)}")


@plan
def dq05_unmarked_commits(d: Spark) -> str:
    """Committed outputs without the marker, by request."""
    return _find(d, "DQ-5", "medium", "run", "pr_id", _fmt(d, "%d outputs, agent %s", "count(*)", "min(agent_name)"), f"FROM outputs WHERE l_linestatus = 'F' AND committed_at BETWEEN {_ago(d, 2, COMMITS_AS_OF)} AND {d.ts(COMMITS_AS_OF)} GROUP BY pr_id")


@plan
def dq06_unpriced_models(d: Spark) -> str:
    """Models with tokens and no cost in seven days: critical."""
    return _find(d, "DQ-6", "critical", "model", "model_id", _fmt(d, "%d calls, %d tokens", "count(*)", d.big("sum(tokens_in + tokens_out)")), f"FROM priced WHERE event_time >= {_ago(d, 7)} AND tokens_in IS NOT NULL AND cost_nano IS NULL AND model_id IS NOT NULL GROUP BY model_id")


@plan
def dq06c_placeholder_prices(d: Spark) -> str:
    return _find(d, "DQ-6c", "high", "model", "model_id", _fmt(d, "%d calls", "count(*)"), f"FROM priced WHERE event_time >= {_ago(d, 7)} AND coalesce(placeholder, false) GROUP BY model_id")


@plan
def dq07_unknown_issues(d: Spark) -> str:
    """Issue keys of two days' runs that no issue has."""
    return _find(d, "DQ-7", "medium", "jira_issue", "r.issue_key", _fmt(d, "%d runs", "count(*)"), f"FROM (SELECT concat('IML-', user_id * 211) AS issue_key FROM runs WHERE started_at >= {_ago(d, 2)}) AS r WHERE NOT EXISTS (SELECT 1 FROM {_ISSUES} AS i WHERE i.issue_key = r.issue_key) GROUP BY r.issue_key")


@plan
def dq08_done_without_start(d: Spark) -> str:
    """Issues done in two months that were never in progress."""
    return _find(d, "DQ-8", "low", "jira_issue", "issue_key", _fmt(d, "%d transitions", "coalesce(transition_count, 0)"), f"FROM {_ISSUES} AS i WHERE done_at IS NOT NULL AND first_in_progress_at IS NULL AND done_at >= {_ago(d, 60, ORDERS_AS_OF)}")


@plan
def dq09a_commits_without_request(d: Spark) -> str:
    """Outputs committed three to ten days ago that belong to no request."""
    a = COMMITS_AS_OF
    return _find(d, "DQ-9", "medium", "output", "output_id", _fmt(d, "committed %s", d.day_key("committed_at")), f"FROM (SELECT output_id, committed_at, CASE WHEN l_partkey % 13 > 0 THEN pr_id END AS request FROM outputs) AS o WHERE request IS NULL AND committed_at < {_ago(d, 3, a)} AND committed_at >= {_ago(d, 10, a)}")


@plan
def dq09b_requests_without_commits(d: Spark) -> str:
    """Recent requests without a commit."""
    return _find(d, "DQ-9", "low", "pull_request", "concat(p.repo, '#', p.pr_id)", "'no commits'", f"FROM prs p LEFT JOIN (SELECT pr_id, count(*) AS n FROM outputs WHERE NOT reused GROUP BY pr_id) AS o ON p.pr_id = o.pr_id WHERE coalesce(o.n, 0) = 0 AND p.created_on >= {_ago(d, 90, ORDERS_AS_OF)}")


@plan
def dq10a_clock_skew(d: Spark) -> str:
    """Events over 300 seconds ahead of their arrival."""
    ahead = d.diff("SECOND", "ingested_at", "event_time")
    return _find(d, "DQ-10", "medium", "event", "event_id", _fmt(d, "%d seconds, %s", ahead, "event_type"), f"FROM (SELECT event_id, event_type, event_time + {d.hours('k % 40')} AS event_time, ingested_at FROM ev) AS e WHERE event_time >= {_ago(d, 2)} AND ingested_at IS NOT NULL AND {ahead} > 300")


@plan
def dq10b_ends_before_starts(d: Spark) -> str:
    return _find(d, "DQ-10", "high", "run", "run_id", _fmt(d, "%d seconds", d.diff("SECOND", "started_at", "ended_at")), "FROM fct_run WHERE ended_at IS NOT NULL AND ended_at < started_at")


@plan
def dq11a_redelivery_rate(d: Spark) -> str:
    """How much is delivered again: expected, but medium over 95 percent."""
    return _find(d, "DQ-11", "CASE WHEN (n - ids) * 1e0 / nullif(n, 0) > 0.95 THEN 'medium' ELSE 'info' END", "dataset", "'deliveries'", _fmt(d, "%d deliveries of %d events", "n", "ids"), "FROM (SELECT count(*) AS n, count(DISTINCT event_id) AS ids FROM delivered) AS a")


@plan
def dq11b_payload_collisions(d: Spark) -> str:
    """One natural key with different payloads: critical."""
    key = f"concat(person_id, '_', event_type, '_', {d.day_key('event_time')}, '_', hour(event_time))"
    return _find(d, "DQ-11", "critical", "event", "id", _fmt(d, "%d deliveries, %d payloads", "count(*)", "count(DISTINCT concat_ws('|', k, value))"), f"FROM (SELECT {key} AS id, k, value FROM delivered) AS e GROUP BY id HAVING count(DISTINCT concat_ws('|', k, value)) > 1")


@plan
def dq12a_empty_benchmark(d: Spark) -> str:
    """A lookup without rows is reported."""
    return _find(d, "DQ-12", "info", "dataset", "'task_benchmark'", "'empty'", "FROM (SELECT count(*) AS n FROM region WHERE r_name = 'ATLANTIS') AS b WHERE n = 0")


@plan
def dq12b_unmatched_tasks(d: Spark) -> str:
    """Outputs whose agent and kind no benchmark covers; a benchmark without an agent covers all."""
    kind = "CASE l_partkey % 3 WHEN 0 THEN 'test' WHEN 1 THEN 'doc' ELSE 'code' END"
    return _find(d, "DQ-12", "low", "dimension", "concat(agent_name, '/', kind)", _fmt(d, "%d outputs", "count(*)"), f"FROM (SELECT agent_name, {kind} AS kind FROM outputs) AS o WHERE NOT EXISTS (SELECT 1 FROM (VALUES ('test', CAST(NULL AS {'STRING' if d.name == 'spark' else 'VARCHAR'})), ('doc', 'agent_1'), ('code', 'agent_2')) AS b(b_kind, b_agent) WHERE b_kind = kind AND (b_agent IS NULL OR b_agent = agent_name)) GROUP BY agent_name, kind")


@plan
def dq13_late_arrivals(d: Spark) -> str:
    """Arrivals over seven days late, high over thirty; model calls are exempt."""
    late = d.diff("DAY", "event_time", "ingested_at")
    return _find(d, "DQ-13", f"CASE WHEN {late} > 30 THEN 'high' ELSE 'info' END", "event", "event_id", _fmt(d, "%d days, %s", late, "event_type"), f"FROM (SELECT event_id, event_type, event_time, ingested_at + {d.days('n % 4 * 9')} AS ingested_at FROM ev) AS e WHERE ingested_at IS NOT NULL AND {late} > 7 AND event_type <> 'model.call'")


@plan
def dq14_coverage_jumps(d: Spark) -> str:
    """Coverage that moves over thirty points between runs of a repository."""
    return _find(d, "DQ-14", "medium", "run", "run_id", _fmt(d, "%d from %d, after %s", "pct", "before", "before_run"), f"""
FROM (SELECT run_id, started_at, pct, lag(pct) OVER (PARTITION BY repo ORDER BY started_at, run_id) AS before, lag(run_id) OVER (PARTITION BY repo ORDER BY started_at, run_id) AS before_run
  FROM (SELECT r.run_id, r.started_at, concat('ws/repo', r.user_id % 40) AS repo, max(g.k) AS pct FROM runs r JOIN gates g ON r.run_id = g.run_id WHERE g.gate_name = 'coverage' GROUP BY r.run_id, r.started_at, r.user_id) AS a) AS b
WHERE before IS NOT NULL AND abs(pct - before) > 30 AND started_at >= {_ago(d, 9)}""")


@plan
def dq15_cardinality(d: Spark) -> str:
    """Dimensions with over 100 values, critical from 500."""
    dims = ("agent_name", "skill_name", "surface", "link_method", "event_type", "person_id", "run_id")
    one = "SELECT " + ", ".join(f"count(DISTINCT {c}) AS {c}" for c in dims) + f" FROM ev WHERE event_time >= {_ago(d, 30)}"
    pick = " ".join(f"WHEN '{c}' THEN {c}" for c in dims)
    return _find(d, "DQ-15", "CASE WHEN n >= 500 THEN 'critical' ELSE 'high' END", "dimension", "dim", _fmt(d, "%d values", "n"), f"FROM (SELECT v.dim, CASE v.dim {pick} END AS n FROM ({one}) AS a CROSS JOIN (VALUES {', '.join(f'''('{c}')''' for c in dims)}) AS v(dim)) AS x WHERE n > 100")


@plan
def dq16_claimed_twice(d: Spark) -> str:
    """Outputs that several runs claim, with the first five claimants."""
    return _find(d, "DQ-16", "critical", "output", "concat_ws('-', l_orderkey, l_linenumber)", _fmt(d, "%d claims (%s)", "count(DISTINCT l_suppkey)", d.joined("concat('run_', l_suppkey)", 5)), "FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(DISTINCT l_suppkey) > 1")


@plan
def dq17a_unbound_runs(d: Spark) -> str:
    return _find(d, "DQ-17", "high", "run", "run_id", _fmt(d, "agent %s, surface %s", "coalesce(agent_name, 'unknown')", "coalesce(surface, 'unknown')"), f"FROM (SELECT run_id, agent_name, surface, started_at, CASE WHEN user_id % 9 > 0 THEN trace_id END AS bound FROM runs) AS r WHERE started_at >= {_ago(d, 2)} AND bound IS NULL AND coalesce(surface, 'unknown') IN ('vscode-copilot-chat', 'copilot-cli')")


@plan
def dq17b_bound_without_usage(d: Spark) -> str:
    return _find(d, "DQ-17", "high", "run", "r.run_id", _fmt(d, "session %s", "r.trace_id"), f"FROM runs r LEFT JOIN usage u ON r.trace_id = u.trace_id WHERE r.started_at >= {_ago(d, 2)} AND r.trace_id IS NOT NULL AND u.tokens_in IS NULL")


@plan
def dq_gate_without_verdict(d: Spark) -> str:
    """Gates with evaluations that have no verdict, high over a third."""
    n = d.big("count_if(verdict IS NULL)")
    return _find(d, "DQ-GATE", f"CASE WHEN {n} * 1e0 / count(*) > 0.33 THEN 'high' ELSE 'info' END", "dimension", "gate_name", _fmt(d, "%d of %d", n, "count(*)"), f"FROM gates WHERE event_time >= {_ago(d, 7)} GROUP BY gate_name HAVING {n} > 0")


@plan
def dq_cov_measured(d: Spark) -> str:
    return _find(d, "DQ-COV", "info", "dataset", "'surface_coverage'", _fmt(d, "%d measured, %d not", d.big("count_if(coalesce(surface, 'unknown') IN ('copilot-cli', 'headless'))"), d.big("count_if(coalesce(surface, 'unknown') NOT IN ('copilot-cli', 'headless'))")), f"FROM runs WHERE started_at >= {_ago(d, 7)}")


@plan
def dq_cov_unmeasured(d: Spark) -> str:
    return _find(d, "DQ-COV", "medium", "dimension", "coalesce(surface, 'unknown')", _fmt(d, "%d runs", "count(*)"), f"FROM runs WHERE started_at >= {_ago(d, 7)} AND coalesce(surface, 'unknown') NOT IN ('copilot-cli', 'headless') GROUP BY coalesce(surface, 'unknown')")


@plan
def dq_grain_wrong_side(d: Spark) -> str:
    """Runs measured the other way than the cutover says."""
    return _find(d, "DQ-GRAIN", "critical", "run", "run_id", _fmt(d, "%s on %s", "source", d.day_key("run_date")), f"FROM (SELECT run_id, run_date, {_USAGE} AS source FROM fct_run) AS r CROSS JOIN (SELECT DATE '2024-01-16' AS cut) AS c WHERE (run_date >= cut AND source = 'otel_span') OR (run_date < cut AND source = 'session_journal')")


@plan
def dq_grain_mixed_days(d: Spark) -> str:
    """Days off the cutover whose rows put both grains together."""
    return _find(d, "DQ-GRAIN", "high", "dataset", d.day_key("run_date"), _fmt(d, "%d agents", "count(*)"), f"FROM (SELECT run_date, agent_name FROM (SELECT run_date, agent_name, {_USAGE} AS source FROM fct_run) AS r WHERE source <> 'none' GROUP BY run_date, agent_name HAVING count(DISTINCT source) > 1) AS m WHERE run_date <> DATE '2024-01-16' GROUP BY run_date")


@plan
def dq_grain_boundary(d: Spark) -> str:
    """The cutover that the table states against the first day of the later grain."""
    first = f"min(CASE WHEN {_USAGE} = 'session_journal' THEN run_date END)"
    return _find(d, "DQ-GRAIN", "high", "dimension", "'grain_cutover'", _fmt(d, "first %s", d.day_key(first)), f"FROM fct_run HAVING {first} IS DISTINCT FROM DATE '2024-01-15'")


@plan
def dq_attr_shared_cost(d: Spark) -> str:
    """Costs on runs that share a session: none may have one, so rows are a breach."""
    return _find(d, "DQ-ATTR", "critical", "run", "r.run_id", _fmt(d, "%d others", "s.run_count - 1"), "FROM runs r JOIN sessions s ON r.trace_id = s.trace_id JOIN usage u ON r.trace_id = u.trace_id WHERE s.run_count > 1 AND u.cost_nano IS NOT NULL")


@plan
def dq_tool_status_coverage(d: Spark) -> str:
    """How many tool calls carry a status, high where over half do not."""
    none = d.big("count_if(status IS NULL)")
    return _find(d, "DQ-TOOL", f"CASE WHEN {none} * 1e0 / count(*) > 0.5 THEN 'high' ELSE 'info' END", "dataset", "'tool.call.status'", _fmt(d, "%d of %d, %d errors", "count(status)", "count(*)", d.big("count_if(status = 'error')")), f"FROM tools WHERE event_time >= {_ago(d, 7)} HAVING count(*) > 0")


@plan
def dq_tool_unknown_status(d: Spark) -> str:
    """Statuses outside the closed list."""
    return _find(d, "DQ-TOOL", "high", "dimension", "concat('tool.call.status:', st)", _fmt(d, "%d calls", "count(*)"), f"FROM (SELECT CASE WHEN k % 17 = 3 THEN 'done' WHEN k % 17 = 4 THEN 'OK' ELSE status END AS st, event_time FROM tools) AS t WHERE event_time >= {_ago(d, 7)} AND st IS NOT NULL AND st NOT IN ('ok', 'error') GROUP BY st")


@plan
def dq_model_without_price(d: Spark) -> str:
    """Models without a price on the days of their calls."""
    return _find(d, "DQ-MODEL", "high", "model", "c.model_id", _fmt(d, "%d calls", "count(*)"), f"FROM calls c WHERE c.event_time >= {_ago(d, 7)} AND c.model_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM prices p WHERE p.model_id = c.model_id AND c.call_date BETWEEN p.effective_from AND coalesce(p.effective_to, DATE '9999-12-31')) GROUP BY c.model_id")


@plan
def dq_path_absolute(d: Spark) -> str:
    """Runs with absolute paths: the shape is reported, never the path."""
    shape = "CASE WHEN path LIKE '/Users/%' THEN 'posix-home-macos' WHEN path LIKE '/home/%' THEN 'posix-home-linux' WHEN path LIKE '/%' THEN 'posix-absolute' ELSE 'windows-drive-absolute' END"
    return _find(d, "DQ-PATH", "critical", "run", "run_id", _fmt(d, "%d paths (%s)", "count(*)", d.joined("shape")), f"FROM (SELECT run_id, {shape} AS shape FROM (SELECT run_id, event_time, {_PATHS} AS path FROM turns) AS t WHERE event_time >= {_ago(d, 2)} AND (path LIKE '/%' OR {d.like_re('path', '^[A-Za-z]:[/]')})) AS x GROUP BY run_id")


@plan
def dq_link_explicit_share(d: Spark) -> str:
    """The share of tokens on explicitly linked calls, high under five percent."""
    part, whole = "sum(CASE WHEN link_method = 'explicit' THEN tokens_in + tokens_out ELSE 0 END)", "sum(tokens_in + tokens_out)"
    return _find(d, "DQ-LINK", f"CASE WHEN {part} * 1e0 / nullif({whole}, 0) < 0.05 THEN 'high' ELSE 'info' END", "dataset", "'cost_per_accepted'", _fmt(d, "%d of %d tokens", d.big(part), d.big(whole)), f"FROM calls WHERE event_time >= {_ago(d, 7)} AND tokens_in IS NOT NULL HAVING {whole} > 0")
