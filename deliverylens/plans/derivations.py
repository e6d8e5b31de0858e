"""More telemetry plans: predicates, folds, derived facts, person and coverage reports."""

from __future__ import annotations

from .catalogue import k_guard, plan, rate
from .dialect import Spark
from .relations import EVENTS_AS_OF, ORDERS_AS_OF


def _array(d: Spark, *items: str) -> str:
    return f"array({', '.join(items)})" if d.name == "spark" else f"[{', '.join(items)}]"


def _unnest(d: Spark, x: str) -> str:
    return f"explode({x})" if d.name == "spark" else f"unnest({x})"


def _replace(d: Spark, x: str, pattern: str, by: str) -> str:
    return f"regexp_replace({x}, '{pattern}', '{by}'{'' if d.name == 'spark' else ', ' + repr('g')})"


# ---- scans and predicates


@plan
def s02_widened_scan(d: Spark) -> str:
    """Calls of three days read with a day more on either side, then cut by the exact time."""
    a, b = d.ts("2024-01-10 06:00:00"), d.ts("2024-01-13 18:00:00")
    return f"SELECT event_id, model_id, tokens_in FROM calls WHERE call_date BETWEEN {d.date('2024-01-09')} AND {d.date('2024-01-14')} AND event_time BETWEEN {a} AND {b}"


@plan
def s03_call_totals(d: Spark) -> str:
    """Total tokens and the model in effect; unknown counts stay unknown."""
    return "SELECT event_id, tokens_in + tokens_out AS total_tokens, CASE WHEN k % 11 = 0 THEN 'm_default' ELSE model_id END AS effective_model_id FROM calls"


@plan
def p05_three_valued_flags(d: Spark) -> str:
    return f"SELECT agent_name, {d.big('count_if(cost_attributable IS TRUE)')} AS yes, {d.big('count_if(cost_attributable IS FALSE)')} AS no, {d.big('count_if(NOT coalesce(has_unpriced, false))')} AS priced, {d.big('count_if(has_unpriced IS NULL)')} AS unknown FROM fct_run GROUP BY agent_name"


@plan
def p06_distinct_from(d: Spark) -> str:
    return "SELECT count(*) AS n FROM fct_run a JOIN fct_run b ON a.run_id = b.run_id WHERE a.tool_calls IS DISTINCT FROM b.turns OR a.skill_name IS NOT DISTINCT FROM b.agent_name"


@plan
def p10_having(d: Spark) -> str:
    return "SELECT tool_name, count(*) AS n FROM tools GROUP BY tool_name HAVING count(*) > 5 AND count(status) < count(*)"


@plan
def p12_scalar_subquery(d: Spark) -> str:
    return "SELECT model_id, count(*) AS n FROM calls WHERE tokens_in > (SELECT avg(CAST(tokens_in AS DOUBLE)) FROM calls) GROUP BY model_id"


# ---- joins


@plan
def j04_outputs_to_requests(d: Spark) -> str:
    """Outputs joined with their requests on two keys."""
    return "SELECT o.output_id, p.repo, p.merged_at FROM outputs o JOIN prs p ON o.pr_id = p.pr_id AND o.quarantined = (p.pr_id % 2 = 0)"


@plan
def j07_tenure(d: Spark) -> str:
    """People's role on the day of a run, from an effective-dated table; tenure in weeks."""
    return f"""
SELECT r.run_id, s.role, {d.diff('DAY', 's.since', 'r.started_at')} AS tenure_days FROM runs r LEFT JOIN (
  SELECT c_custkey AS user_id, CASE WHEN c_custkey % 2 = 0 THEN 'dev' ELSE 'qa' END AS role, {d.ts('2023-06-01 00:00:00')} + {d.days('c_custkey % 100')} AS since, CASE WHEN c_custkey % 3 = 0 THEN {d.ts('2024-01-15 00:00:00')} END AS until FROM customer) s
ON r.user_id = s.user_id AND r.started_at >= s.since AND r.started_at < coalesce(s.until, {d.ts('9999-12-31 00:00:00')})"""


@plan
def j11_requests_with_sums(d: Spark) -> str:
    return f"SELECT p.pr_id, a.n, a.lines FROM prs p LEFT JOIN (SELECT pr_id, count(*) AS n, {d.big('sum(lines_added)')} AS lines FROM outputs WHERE NOT reused GROUP BY pr_id) a ON p.pr_id = a.pr_id"


@plan
def j12_membership_flag(d: Spark) -> str:
    """Runs whose skill others use too."""
    return f"SELECT r.agent_name, count(*) AS n, {d.big('count_if(s.skill_name IS NOT NULL)')} AS shared FROM runs r LEFT JOIN (SELECT skill_name FROM runs GROUP BY skill_name HAVING count(DISTINCT person_id) >= 2) s ON r.skill_name = s.skill_name GROUP BY r.agent_name"


@plan
def j15_cutover_cross_join(d: Spark) -> str:
    """Runs on either side of the one-row cutover table."""
    return f"SELECT r.run_date >= c.cut AS after_cut, count(*) AS n FROM fct_run r CROSS JOIN (SELECT {d.date('2024-01-16')} AS cut) AS c GROUP BY r.run_date >= c.cut"


@plan
def j16_exploded_aliases(d: Spark) -> str:
    """Aliases of people, one row each."""
    return f"SELECT c_custkey, alias FROM (SELECT c_custkey, {_unnest(d, _array(d, 'lower(c_name)', 'c_mktsegment', 'substr(c_name, 1, 4)'))} AS alias FROM customer) AS x"


# ---- aggregates


@plan
def a05_filtered_distinct(d: Spark) -> str:
    return "SELECT agent_name, count(DISTINCT CASE WHEN status = 'error' THEN tool_name END) AS failing_tools, count(DISTINCT CASE WHEN status = 'ok' THEN run_id END) AS ok_runs FROM tools GROUP BY agent_name"


@plan
def a07_null_preserving_sums(d: Spark) -> str:
    return f"SELECT trace_id, {d.big('sum(tokens_in)')} AS tokens, {d.big('sum(CASE WHEN k % 2 = 0 THEN tokens_in END)')} AS even_tokens, {d.big('sum(CASE WHEN k % 2 = 0 THEN coalesce(tokens_in, 0) ELSE 0 END)')} AS even_or_zero FROM calls GROUP BY trace_id"


@plan
def a11_logical(d: Spark) -> str:
    return "SELECT person_id, bool_and(cost_nano IS NOT NULL) AS all_priced, bool_or(placeholder) AS any_placeholder FROM priced GROUP BY person_id"


@plan
def a12_all_or_nothing(d: Spark) -> str:
    return f"SELECT person_id, CASE WHEN bool_and(cost_nano IS NOT NULL) THEN {d.big('sum(cost_nano)')} END AS cost_nano, count(*) AS n FROM priced GROUP BY person_id"


@plan
def a26_most_common(d: Spark) -> str:
    return "SELECT surface, tool_name, n FROM (SELECT surface, tool_name, n, row_number() OVER (PARTITION BY surface ORDER BY n DESC, tool_name) AS nth FROM (SELECT surface, tool_name, count(*) AS n FROM tools GROUP BY surface, tool_name) AS a) AS b WHERE nth <= 3"


@plan
def a30_last_per_key(d: Spark) -> str:
    key = "struct(event_time, event_id)" if d.name == "spark" else "row(event_time, event_id)"
    return f"SELECT run_id, max(k) AS deepest, {d.top('event_type', key)} AS last_type FROM ev GROUP BY run_id"


@plan
def a31_set_sizes(d: Spark) -> str:
    return f"SELECT {d.month('event_time')} AS mon, count(DISTINCT person_id) AS people, count(DISTINCT trace_id) AS sessions, count(DISTINCT coalesce(skill_name, agent_name)) AS assets FROM ev GROUP BY 1"


@plan
def a33_range(d: Spark) -> str:
    return "SELECT model_id, min(tokens_in) AS low, max(tokens_in) AS high, count(tokens_in) AS known FROM calls GROUP BY model_id"


@plan
def a35_session_folds(d: Spark) -> str:
    return f"SELECT trace_id, min(event_time) AS first_at, max(event_time) AS last_at, {d.joined('agent_name')} AS agents, {d.big('sum(coalesce(tokens_in, 0))')} AS tokens, count(*) AS calls FROM calls GROUP BY trace_id"


# ---- windows and sorts


@plan
def w02_first_terminal(d: Spark) -> str:
    return "SELECT run_id, ended_at, terminal_status FROM terminal"


@plan
def w05_dominant_model(d: Spark) -> str:
    """The model with most tokens of each session; unknown counts rank last."""
    return "SELECT trace_id, model_id FROM (SELECT trace_id, model_id, row_number() OVER (PARTITION BY trace_id ORDER BY coalesce(t, -1) DESC, model_id) AS nth FROM (SELECT trace_id, model_id, sum(tokens_in + tokens_out) AS t FROM calls GROUP BY trace_id, model_id) AS a) AS b WHERE nth = 1"


@plan
def w06_last_attempts(d: Spark) -> str:
    return "SELECT run_id, gate_name, verdict, attempt FROM gate_final"


@plan
def w07_first_request(d: Spark) -> str:
    """The earliest request of each part and repository."""
    return "SELECT l_partkey, repo, pr_id FROM (SELECT o.l_partkey, p.repo, p.pr_id, row_number() OVER (PARTITION BY o.l_partkey, p.repo ORDER BY p.created_on, p.pr_id, o.output_id) AS nth FROM outputs o JOIN prs p ON o.pr_id = p.pr_id) AS a WHERE nth = 1"


@plan
def w13_turn_index(d: Spark) -> str:
    return f"SELECT event_id, {d.big('row_number() OVER (PARTITION BY trace_id ORDER BY event_time, event_id) - 1')} AS turn_index, {d.big('row_number() OVER (PARTITION BY trace_id, turn_kind ORDER BY event_time, event_id)')} AS of_kind FROM turns"


@plan
def w15_missed_streak(d: Spark) -> str:
    """Working days without a report, counted back from the last day."""
    dow = "dayofweek(day)" if d.name == "spark" else "(dayofweek(day) + 1)"
    return f"""
SELECT user_id, {d.big('coalesce(min(CASE WHEN n IS NOT NULL THEN back END) - 1, max(back))')} AS streak FROM (
  SELECT s.user_id, s.day, t.n, row_number() OVER (PARTITION BY s.user_id ORDER BY s.day DESC) AS back
  FROM (SELECT user_id, day FROM (SELECT DISTINCT user_id FROM ev) AS u CROSS JOIN (SELECT day FROM (SELECT {d.explode_days(d.date('2024-01-02'), d.date('2024-01-29'))} AS day) AS z WHERE {dow} BETWEEN 2 AND 6) AS w) AS s
  LEFT JOIN (SELECT user_id, {d.day('event_time')} AS day, count(*) AS n FROM turns WHERE turn_kind = 'approval' GROUP BY user_id, {d.day('event_time')}) AS t ON s.user_id = t.user_id AND s.day = t.day) AS x GROUP BY user_id"""


@plan
def w17_running_agent(d: Spark) -> str:
    """The run in progress as of each event of a person's session."""
    seen = "CASE WHEN event_type = 'run.started' THEN run_id END"
    frame = "OVER (PARTITION BY trace_id ORDER BY event_time, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    last = f"last_value({seen}, true) {frame}" if d.name == "spark" else f"last_value({seen} IGNORE NULLS) {frame}"
    return f"SELECT event_id, {last} AS current_run FROM ev"


@plan
def t05_sentinel_last(d: Spark) -> str:
    return f"SELECT label, n, {d.big('row_number() OVER (ORDER BY CASE WHEN label = ~unset~ THEN 1 ELSE 0 END, label)'.replace(chr(126), chr(39)))} AS place FROM (SELECT coalesce(automation_status, 'unset') AS label, count(*) AS n FROM cases GROUP BY coalesce(automation_status, 'unset')) AS a"


# ---- scalar functions


@plan
def f13_date_arithmetic(d: Spark) -> str:
    return f"SELECT pr_id, created_on - {d.days('21')} AS back, created_on + {d.hours('30')} AS ahead, {d.day('created_on')} AS day FROM prs"


@plan
def f27_local_day(d: Spark) -> str:
    """Days at a fixed offset of seven hours."""
    return f"SELECT {d.day('event_time + ' + d.hours('7'))} AS local_day, count(*) AS n FROM ev GROUP BY 1"


@plan
def f34_trailers(d: Spark) -> str:
    """The last value of a commit trailer."""
    msg = "concat('fix', chr(10), 'Run-Id: r', o_orderkey % 7, chr(10), CASE WHEN o_orderkey % 3 = 0 THEN concat('run-id: r', o_orderkey % 5) ELSE 'x' END)"
    pick = f"nullif(regexp_extract({msg}, '(?is)^.*(?:^|\\n)run-id: *([^\\n]+)', 1), '')" if d.name == "duck" else f"nullif(regexp_extract({msg}, r'(?is)^.*(?:^|\\n)run-id: *([^\\n]+)', 1), '')"
    return f"SELECT v, count(*) AS n FROM (SELECT {pick} AS v FROM orders) AS a GROUP BY v"


@plan
def f43_model_names(d: Spark) -> str:
    raw = "concat('route/', model_id, '-', k % 5, '-', k % 3)"
    by = "-$1.$2" if d.name == "spark" else "-\\1.\\2"
    return f"SELECT name, count(*) AS n FROM (SELECT {_replace(d, _replace(d, raw, '^.*/', ''), '-([0-9]+)-([0-9]+)$', by)} AS name FROM calls) AS a GROUP BY name"


@plan
def f54_programs(d: Spark) -> str:
    cmd = "CASE k % 4 WHEN 0 THEN 'git status' WHEN 1 THEN '/usr/bin/env x' WHEN 2 THEN 'pytest -q' ELSE '' END"
    return f"SELECT prog, count(*) AS n FROM (SELECT CASE WHEN w <> '' AND w NOT LIKE '%/%' AND length(w) <= 40 THEN w END AS prog FROM (SELECT split_part({cmd}, ' ', 1) AS w FROM tools) AS a) AS b GROUP BY prog"


# ---- derived facts


@plan
def d19_case_scope(d: Spark) -> str:
    """Coverage of the cases in scope of an order cycle (semi join)."""
    return f"SELECT priority, count(*) AS n, {d.big('''count_if(automation_status = 'Automated')''')} AS automated FROM cases WHERE case_id IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45) AND NOT archived GROUP BY priority"


@plan
def x05_run_sessions(d: Spark) -> str:
    return "SELECT r.run_id, r.trace_id, s.run_count, s.run_count = 1 AS attributable FROM runs r JOIN sessions s ON r.trace_id = s.trace_id"


@plan
def x16_run_costs(d: Spark) -> str:
    """A session's totals go to its run only where it has one."""
    return "SELECT r.run_id, CASE WHEN s.run_count = 1 THEN u.tokens_in END AS tokens_in, CASE WHEN s.run_count = 1 THEN u.cost_nano END AS cost_nano FROM runs r JOIN sessions s ON r.trace_id = s.trace_id LEFT JOIN usage u ON r.trace_id = u.trace_id"


@plan
def x20_turn_rollup(d: Spark) -> str:
    return "SELECT run_id, turns, corrections, rejections, approvals, clarifications FROM turn_rollup"


@plan
def x24_tool_rollup(d: Spark) -> str:
    return "SELECT run_id, tool_calls, tool_errors, tool_known FROM tool_rollup"


@plan
def x36_output_requests(d: Spark) -> str:
    return "SELECT o.output_id, o.pr_id, p.repo, o.committed_at > p.first_review_at AS after_review FROM outputs o JOIN prs p ON o.pr_id = p.pr_id"


@plan
def x51_output_aggregates(d: Spark) -> str:
    return f"SELECT agent_name, acceptance_state, acceptance_reason, count(*) AS n, {d.big('sum(lines_added)')} AS lines FROM fct_output GROUP BY agent_name, acceptance_state, acceptance_reason"


@plan
def m06_run_reuse(d: Spark) -> str:
    return f"SELECT {d.month('r.started_at')} AS mon, count(*) AS n, {d.big('count_if(s.skill_name IS NOT NULL)')} AS reused, CAST({k_guard('count(*)', rate('count_if(s.skill_name IS NOT NULL)', 'count(*)'))} AS DOUBLE) AS reuse_rate FROM runs r LEFT JOIN (SELECT skill_name, {d.month('started_at')} AS mon FROM runs WHERE skill_name IS NOT NULL GROUP BY skill_name, {d.month('started_at')} HAVING count(*) >= 5 AND count(DISTINCT person_id) >= 2) s ON r.skill_name = s.skill_name AND {d.month('r.started_at')} = s.mon GROUP BY {d.month('r.started_at')}"


# ---- reports


@plan
def g03_weekly_runs(d: Spark) -> str:
    return f"SELECT {d.iso_week('started_at')} AS iso_week, agent_name, count(*) AS n FROM runs GROUP BY 1, agent_name"


@plan
def g04_weekly_terminals(d: Spark) -> str:
    return f"SELECT {d.iso_week('started_at')} AS iso_week, terminal_status, count(*) AS n, median(CAST(CASE WHEN duration_s > 0 THEN duration_s END AS DOUBLE)) AS median_s FROM fct_run GROUP BY 1, terminal_status"


@plan
def g08_weekly_turns(d: Spark) -> str:
    return f"SELECT {d.iso_week('event_time')} AS iso_week, turn_kind, count(*) AS n, count(DISTINCT run_id) AS n_runs FROM turns GROUP BY 1, turn_kind"


@plan
def g09_weekly_outputs(d: Spark) -> str:
    return f"SELECT {d.iso_week('created_on')} AS iso_week, coalesce(acceptance_state, 'in_flight') AS state, count(*) AS n, {d.big('sum(lines_added)')} AS lines FROM fct_output GROUP BY 1, coalesce(acceptance_state, 'in_flight')"


@plan
def g15_inventory(d: Spark) -> str:
    return f"SELECT priority, {d.big('count_if(NOT archived)')} AS live, {d.big('count_if(archived)')} AS archived, {d.big('count_if(NOT archived AND automation_status IS NOT NULL)')} AS classified, CAST({rate('''count_if(NOT archived AND automation_status = 'Automated')''', 'count_if(NOT archived AND automation_status IS NOT NULL)')} AS DOUBLE) AS coverage FROM cases GROUP BY priority"


@plan
def g16_weekly_trend(d: Spark) -> str:
    """Trailing weeks with the step from the week before."""
    return f"SELECT wk, n, n - lag(n) OVER (ORDER BY wk) AS step FROM (SELECT {d.week('event_time')} AS wk, count(*) AS n FROM ev GROUP BY {d.week('event_time')}) AS a"


@plan
def h02_coverage_known_only(d: Spark) -> str:
    return f"SELECT {d.big('''count_if(automation_status = 'Automated')''')} AS automated, {d.big('''count_if(lower(automation_status) LIKE 'to be%')''')} AS to_be, {d.big('count_if(automation_status IS NULL)')} AS unset, {d.big('count_if(archived)')} AS archived, CAST({rate('''count_if(automation_status = 'Automated')''', 'count(automation_status)')} AS DOUBLE) AS known_pct FROM cases"


@plan
def h05_request_details(d: Spark) -> str:
    return f"SELECT p.pr_id, p.repo, c.team, {d.diff('HOUR', 'p.created_on', 'p.merged_at')} AS lead_h, w.generated, w.after_review FROM prs p LEFT JOIN people c ON p.author = c.c_custkey LEFT JOIN rework w ON p.pr_id = w.pr_id"


@plan
def h07_usage_by_person(d: Spark) -> str:
    return f"SELECT person_id, {d.iso_week('event_time')} AS iso_week, count(*) AS calls, count(DISTINCT {d.day('event_time')}) AS active_days, count(DISTINCT trace_id) AS sessions, {d.big('sum(tokens_in + tokens_out)')} AS tokens FROM calls GROUP BY person_id, 2"


@plan
def h10_week_totals(d: Spark) -> str:
    return f"SELECT {d.iso_week('created_on')} AS iso_week, {d.big('''count_if(st = 'O')''')} AS raised, {d.big('''count_if(st = 'F')''')} AS fixed, count(DISTINCT author) AS people FROM prs GROUP BY 1"


@plan
def h12_first_to_last_week(d: Spark) -> str:
    """Change of a person's activity from the first to the last week."""
    return f"SELECT person_id, {d.low('n', 'wk')} AS first_n, {d.top('n', 'wk')} AS last_n, {d.top('n', 'wk')} - {d.low('n', 'wk')} AS change FROM (SELECT person_id, {d.week('event_time')} AS wk, count(*) AS n FROM ev GROUP BY person_id, {d.week('event_time')}) AS a GROUP BY person_id HAVING count(*) > 1"


@plan
def h19_activity_strip(d: Spark) -> str:
    """Week sums that stay unknown where no day was covered."""
    return f"SELECT user_id, {d.week('day')} AS wk, {d.big('sum(n)')} AS n, {d.big('count_if(n > 3)')} AS busy_days FROM (SELECT user_id, {d.day('event_time')} AS day, CASE WHEN count(*) > 1 THEN count(*) END AS n FROM ev GROUP BY user_id, {d.day('event_time')}) AS a GROUP BY user_id, {d.week('day')}"


@plan
def h21_measured_or(d: Spark) -> str:
    return f"SELECT person_id, bool_or(tokens_in IS NOT NULL) AS measured, count(*) AS calls FROM calls GROUP BY person_id"


@plan
def h26_headline(d: Spark) -> str:
    """Headline sums, where unknown counts as zero."""
    return f"SELECT count(*) AS n_runs, {d.big('sum(coalesce(turns, 0))')} AS turns, {d.big('sum(coalesce(tool_calls, 0))')} AS tool_calls, {d.big('sum(coalesce(cost_nano, 0))')} AS cost_nano FROM fct_run"
