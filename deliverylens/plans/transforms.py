"""Named transforms, reports and scalar rules that the other plans have no entry for."""

from __future__ import annotations

from .catalogue import k_guard, plan, rate
from .derivations import _array, _unnest
from .dialect import Spark
from .relations import EVENTS_AS_OF, ORDERS_AS_OF

def _row(d: Spark, *cols: str) -> str:
    return f"{'struct' if d.name == 'spark' else 'row'}({', '.join(cols)})"


def _text(d: Spark, x: str) -> str:
    return f"CAST({x} AS {'STRING' if d.name == 'spark' else 'VARCHAR'})"


# ---- run transforms


@plan
def x04_run_bound(d: Spark) -> str:
    """The first bind of each run: the new name of the session's attribute before the old one."""
    return "SELECT run_id, bound_at, coalesce(session_new, session_old) AS session_id, issue_key FROM (SELECT run_id, event_time AS bound_at, CASE WHEN k % 3 = 0 THEN concat('s2_', k) END AS session_new, CASE WHEN k % 4 > 0 THEN trace_id END AS session_old, CASE WHEN k % 5 = 0 THEN concat('IML-', k) END AS issue_key, row_number() OVER (PARTITION BY run_id ORDER BY event_time, event_id) AS nth FROM turns) AS a WHERE nth = 1"


@plan
def x17_modelled_calls(d: Spark) -> str:
    """Estimates of emitters: calls that name their run."""
    return "SELECT event_id, run_id, model_id, tokens_in, tokens_out FROM (SELECT *, CASE WHEN surface = 'copilot-cli' THEN run_id END AS named_run FROM calls) AS c WHERE named_run IS NOT NULL"


@plan
def x18_modelled_model(d: Spark) -> str:
    return "SELECT run_id, model_id, n FROM (SELECT run_id, model_id, n, row_number() OVER (PARTITION BY run_id ORDER BY n DESC, model_id) AS nth FROM (SELECT run_id, model_id, count(*) AS n FROM calls GROUP BY run_id, model_id) AS a) AS b WHERE nth = 1"


@plan
def x19_modelled_rollup(d: Spark) -> str:
    """Modelled tokens and cost by run, apart from measured ones."""
    return f"SELECT run_id, count(*) AS calls, {d.big('sum(tokens_in + tokens_out)')} AS modelled_tokens, CASE WHEN bool_and(cost_nano IS NOT NULL) THEN {d.big('sum(cost_nano)')} END AS modelled_nano FROM priced GROUP BY run_id"


@plan
def x25_person_resolved(d: Spark) -> str:
    """People by verified alias, one row an alias; an alias of several people resolves to none."""
    aliases = f"SELECT c_custkey, c_acctbal > 0 AS verified, {_unnest(d, _array(d, 'lower(c_name)', 'substr(c_name, 1, 12)', 'concat(c_mktsegment, c_custkey % 90)'))} AS alias FROM customer"
    return f"SELECT alias, min(c_custkey) AS c_custkey FROM ({aliases}) AS a WHERE coalesce(verified, false) GROUP BY alias HAVING count(DISTINCT c_custkey) = 1"


# ---- output transforms


@plan
def x33_output_commits(d: Spark) -> str:
    """Commits with the outputs that they list, one row each."""
    ids = _array(d, "concat('o', l_partkey)", "concat('o', l_suppkey)")
    return f"SELECT sha, output, count(*) AS n FROM (SELECT concat('c', l_orderkey) AS sha, {_unnest(d, ids)} AS output FROM lineitem) AS c GROUP BY sha, output"


@plan
def x34_request_commits(d: Spark) -> str:
    return "SELECT pr_id, count(*) AS commits, min(committed_at) AS first_at, max(committed_at) AS last_at FROM outputs GROUP BY pr_id"


@plan
def x35_output_history(d: Spark) -> str:
    """First commit, number of commits and any marker of each part's outputs."""
    return f"SELECT l_partkey, min(committed_at) AS first_commit_at, {d.low('output_id', _row(d, 'committed_at', 'output_id'))} AS first_output, count(DISTINCT pr_id) AS commits, bool_or(l_suppkey % 3 = 0) AS marked FROM outputs GROUP BY l_partkey"


@plan
def x37_request_facts(d: Spark) -> str:
    """Requests of 75 days, with what outputs need of them."""
    return f"SELECT pr_id, repo, created_on, first_review_at, merged_at, declined_at, reverted_at FROM prs WHERE created_on >= {d.ts(ORDERS_AS_OF)} - {d.days('75')}"


@plan
def x38_change_split(d: Spark) -> str:
    """Lines by request before and after its first review; null if nobody reviewed."""
    return "SELECT pr_id, generated, after_review, generated - after_review AS before_review FROM rework"


# ---- joins, sorts, filters


@plan
def j02_inner_join(d: Spark) -> str:
    return "SELECT t.event_id, r.agent_name, r.started_at FROM tools t JOIN runs r ON t.run_id = r.run_id"


@plan
def j03_composite_left_join(d: Spark) -> str:
    return "SELECT t.event_id, g.verdict FROM tools t LEFT JOIN gate_final g ON t.run_id = g.run_id AND g.gate_name = CASE t.k % 3 WHEN 0 THEN 'build' WHEN 1 THEN 'test' ELSE 'lint' END"


@plan
def j10_null_safe_left_join(d: Spark) -> str:
    return "SELECT a.agent_name, a.skill_name, a.n, b.calls FROM (SELECT agent_name, skill_name, count(*) AS n FROM runs GROUP BY agent_name, skill_name) a LEFT JOIN (SELECT agent_name, skill_name, count(*) AS calls FROM calls GROUP BY agent_name, skill_name) b ON a.agent_name IS NOT DISTINCT FROM b.agent_name AND a.skill_name IS NOT DISTINCT FROM b.skill_name"


@plan
def j17_mode_by_group(d: Spark) -> str:
    """The most frequent tool of each agent beside its totals."""
    return "SELECT a.agent_name, a.n, m.tool_name FROM (SELECT agent_name, count(*) AS n FROM tools GROUP BY agent_name) a LEFT JOIN (SELECT agent_name, tool_name FROM (SELECT agent_name, tool_name, row_number() OVER (PARTITION BY agent_name ORDER BY count(*) DESC, tool_name) AS nth FROM tools GROUP BY agent_name, tool_name) AS x WHERE nth = 1) m ON a.agent_name = m.agent_name"


@plan
def j18_constant_residual(d: Spark) -> str:
    """Assets joined by name and by a constant kind."""
    return "SELECT r.run_id, a.people FROM runs r LEFT JOIN (SELECT 'agent' AS kind, agent_name AS asset, count(DISTINCT person_id) AS people FROM runs GROUP BY agent_name UNION ALL SELECT 'skill', skill_name, count(DISTINCT person_id) FROM runs WHERE skill_name IS NOT NULL GROUP BY skill_name) a ON r.agent_name = a.asset AND a.kind = 'agent'"


@plan
def j21_people_map(d: Spark) -> str:
    """Events by the team of their person; people whom the map lacks are one group."""
    return "SELECT p.team, count(*) AS n, count(DISTINCT e.user_id) AS people FROM ev e LEFT JOIN people p ON e.user_id = p.c_custkey GROUP BY p.team"


@plan
def t04_cycles_sorted(d: Spark) -> str:
    """Folders by number of cases, then coverage, then name, with their place among the first twenty."""
    return f"SELECT folder, n, automated FROM (SELECT folder, count(*) AS n, {d.big('''count_if(automation_status = 'Automated')''')} AS automated FROM cases GROUP BY folder) AS a ORDER BY n DESC, automated DESC, folder LIMIT 20"


@plan
def t07_recent_only(d: Spark) -> str:
    """What a scan of a descending list stops at is a filter here."""
    return f"SELECT pr_id, created_on FROM prs WHERE created_on >= {d.ts(ORDERS_AS_OF)} - {d.days('120')}"


@plan
def a25_keyed_counts(d: Spark) -> str:
    """Counts by week and key."""
    return f"SELECT {d.iso_week('event_time')} AS iso_week, event_type, surface, count(*) AS n, {d.big('sum(k)')} AS k FROM ev GROUP BY 1, event_type, surface"


@plan
def a18_small_groups_hidden(d: Spark) -> str:
    return f"SELECT agent_name, tool_name, count(status) AS known, CAST({k_guard('count(status)', rate('''count_if(status = 'error')''', 'count(status)'))} AS DOUBLE) AS error_rate FROM tools GROUP BY agent_name, tool_name"


@plan
def a22_two_phases(d: Spark) -> str:
    """A mean over requests of their own means, not over outputs."""
    return "SELECT repo, count(*) AS requests, sum(lines) * 1e0 / count(*) AS mean_lines FROM (SELECT p.repo, p.pr_id, sum(o.lines_added) AS lines FROM prs p JOIN outputs o ON p.pr_id = o.pr_id GROUP BY p.repo, p.pr_id) AS a GROUP BY repo"


@plan
def r04_bounded_lookback(d: Spark) -> str:
    return f"SELECT event_type, count(*) AS n FROM ev WHERE event_time >= {d.ts(EVENTS_AS_OF)} - {d.days('30')} GROUP BY event_type"


@plan
def r08_session_aggregates(d: Spark) -> str:
    return f"SELECT trace_id, count(*) AS n, min(event_time) AS a, max(event_time) AS b, {d.diff('SECOND', 'min(event_time)', 'max(event_time)')} AS span_s FROM ev GROUP BY trace_id"


@plan
def r11_orphans_abandoned(d: Spark) -> str:
    """Runs without an end after a day become abandoned."""
    return f"SELECT run_id, CASE WHEN terminal_status = 'in_flight' AND started_at < {d.ts(EVENTS_AS_OF)} - {d.days('1')} THEN 'abandoned' ELSE terminal_status END AS status FROM fct_run"


@plan
def r13_alert_once(d: Spark) -> str:
    """A person's streak of days without turns is reported when it is longer than the one reported before."""
    return f"SELECT person_id, dy, gap FROM (SELECT person_id, dy, gap, max(gap) OVER (PARTITION BY person_id ORDER BY dy ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS told FROM (SELECT person_id, dy, {d.diff('DAY', 'CAST(lag(dy) OVER (PARTITION BY person_id ORDER BY dy) AS TIMESTAMP)', 'CAST(dy AS TIMESTAMP)')} AS gap FROM (SELECT DISTINCT person_id, {d.day('event_time')} AS dy FROM turns) AS a) AS b) AS c WHERE gap > 1 AND gap > coalesce(told, 0)"


@plan
def r15_prunable_days(d: Spark) -> str:
    """Days whose every event an upload receipt covers; others are kept."""
    return f"SELECT e.dy, count(*) AS n FROM (SELECT {d.day('event_time')} AS dy, event_id FROM ev) AS e LEFT JOIN (SELECT DISTINCT {d.day('event_time')} AS dy, event_id FROM ev WHERE k % 50 > 0 OR event_time < {d.ts('2024-01-10 00:00:00')}) AS r ON e.event_id = r.event_id GROUP BY e.dy HAVING count(r.event_id) = count(*)"


# ---- scalar rules


@plan
def f09_formatted_text(d: Spark) -> str:
    f = "format_string" if d.name == "spark" else "printf"
    return f"SELECT tool_name, {f}('%d calls of %s', count(*), tool_name) AS line FROM tools GROUP BY tool_name"


@plan
def f17_formatted_times(d: Spark) -> str:
    day, clock = ("date_format(event_time, 'yyyy-MM-dd')", "date_format(event_time, 'HH:mm:ss')") if d.name == "spark" else ("strftime(event_time, '%Y-%m-%d')", "strftime(event_time, '%H:%M:%S')")
    return f"SELECT event_id, concat({day}, 'T', {clock}, 'Z') AS at FROM ev"


@plan
def f19_json_array(d: Spark) -> str:
    """Values of a JSON array, one row each."""
    raw = "concat('[~a', k % 3, '~,~b', k % 2, '~]')".replace("~", '"')
    items = f"from_json({raw}, 'array<string>')" if d.name == "spark" else f"CAST(CAST({raw} AS JSON) AS VARCHAR[])"
    return f"SELECT item, count(*) AS n FROM (SELECT {_unnest(d, items)} AS item FROM ev) AS a GROUP BY item"


@plan
def f24_days_between(d: Spark) -> str:
    """Days to four places; least and greatest of two times pass nulls by."""
    days = "round((unix_micros(CAST(merged_at AS TIMESTAMP)) - unix_micros(CAST(created_on AS TIMESTAMP))) / 86400e6, 4)" if d.name == "spark" else "round((epoch_us(merged_at) - epoch_us(created_on)) / 86400e6, 4)"
    return f"SELECT pr_id, {days} AS days, least(merged_at, declined_at) AS closed_at, greatest(created_on, first_review_at) AS seen_at FROM prs"


@plan
def f32_project_keys(d: Spark) -> str:
    return "SELECT split_part(concat(CASE WHEN o_orderkey % 3 = 0 THEN 'IML' ELSE 'PRJ' END, '-', o_orderkey), '-', 1) AS project_key, count(*) AS n FROM orders GROUP BY 1"


@plan
def f53_identity_fallback(d: Spark) -> str:
    """People are compared by account or else by uuid, and named by account alone."""
    return "SELECT account, count(*) AS n, count(DISTINCT coalesce(account, uuid)) AS people FROM (SELECT CASE WHEN c_custkey % 4 > 0 THEN concat('acc', c_custkey % 40) END AS account, concat('u', c_custkey % 7) AS uuid FROM customer) AS a GROUP BY account"


@plan
def f55_uploader(d: Spark) -> str:
    return "SELECT lower(trim(coalesce(mail, machine))) AS uploader, count(*) AS n FROM (SELECT CASE WHEN c_custkey % 3 > 0 THEN concat(' A', c_custkey % 9, '@X ') END AS mail, concat('M', c_custkey % 5) AS machine FROM customer) AS a GROUP BY 1"


@plan
def f57_day_spine(d: Spark) -> str:
    """Days from the first to the last of each order of dates; a span over 400 days or backwards has none."""
    span = d.diff("DAY", "a", "b")
    return f"SELECT pr_id, {d.explode_days('CAST(a AS DATE)', 'CAST(b AS DATE)')} AS day FROM (SELECT pr_id, created_on AS a, coalesce(merged_at, declined_at) AS b FROM prs) AS s WHERE {span} BETWEEN 0 AND 400 AND b >= a"


# ---- reports


@plan
def g12_case_snapshots(d: Spark) -> str:
    return f"SELECT coalesce(automation_status, 'unset') AS status, archived, count(*) AS n, count(DISTINCT folder) AS folders FROM cases GROUP BY coalesce(automation_status, 'unset'), archived"


@plan
def g13_builds(d: Spark) -> str:
    """Builds by gate and verdict with the hours they fell in."""
    return f"SELECT {d.iso_week('event_time')} AS iso_week, coalesce(verdict, 'unknown') AS status, count(*) AS n, count(DISTINCT run_id) AS n_runs FROM gates WHERE gate_name IN ('build', 'test') GROUP BY 1, coalesce(verdict, 'unknown')"


@plan
def g17_latest_complete_week(d: Spark) -> str:
    """The last week that the data cover to its end."""
    return f"SELECT max(wk) AS wk FROM (SELECT {d.week('event_time')} AS wk, max({d.day('event_time')}) AS last FROM ev GROUP BY {d.week('event_time')}) AS a WHERE wk < (SELECT {d.week('max(event_time)')} FROM ev)"


@plan
def h04_summary_basis(d: Spark) -> str:
    """Totals by person with what they rest on: no data is not zero."""
    return f"SELECT p.c_custkey, CASE WHEN e.user_id IS NULL THEN 'no_data' ELSE 'measured' END AS basis, e.turns FROM people p LEFT JOIN (SELECT user_id, {d.big('''count_if(event_type = 'human.turn')''')} AS turns FROM ev GROUP BY user_id) e ON p.c_custkey = e.user_id"


@plan
def h08_coverage_by_cycle(d: Spark) -> str:
    """Cases of each cycle: distinct, automated, the modal folder, first and last."""
    base = "(SELECT concat('cy', l_orderkey % 12) AS cycle, c.case_id, c.folder, c.automation_status FROM lineitem l JOIN cases c ON l.l_partkey = c.case_id)"
    return f"SELECT a.cycle, a.n_cases, a.automated, m.folder, a.first_case, a.last_case FROM (SELECT cycle, count(DISTINCT case_id) AS n_cases, count(DISTINCT CASE WHEN automation_status = 'Automated' THEN case_id END) AS automated, min(case_id) AS first_case, max(case_id) AS last_case FROM {base} AS b GROUP BY cycle) AS a JOIN (SELECT cycle, folder FROM (SELECT cycle, folder, row_number() OVER (PARTITION BY cycle ORDER BY count(*) DESC, folder) AS nth FROM {base} AS b GROUP BY cycle, folder) AS x WHERE nth = 1) AS m ON a.cycle = m.cycle"


@plan
def h29_sources_and_gaps(d: Spark) -> str:
    """Rows and days with data of each source, beside the days of its span."""
    one = lambda t, c: f"SELECT '{t}' AS source, count(*) AS n, count(DISTINCT {d.day(c)}) AS days, {d.diff('DAY', f'min({c})', f'max({c})')} + 1 AS span FROM {t}"
    return " UNION ALL ".join(one(t, c) for t, c in (("ev", "event_time"), ("prs", "created_on"), ("calls", "event_time"), ("gates", "event_time")))


@plan
def d06_decline_reasons(d: Spark) -> str:
    """Why requests were declined: by their author, after requested changes, by another, unknown."""
    return "SELECT reason, count(*) AS n FROM (SELECT CASE WHEN actor = author THEN 'declined_by_author' WHEN changes THEN 'changes_requested_unresolved' WHEN actor IS NOT NULL THEN 'declined_by_reviewer' ELSE 'unknown' END AS reason FROM (SELECT author, CASE pr_id % 4 WHEN 0 THEN author WHEN 1 THEN author + 1 WHEN 2 THEN NULL ELSE author + 2 END AS actor, pr_id % 7 = 1 AS changes FROM prs WHERE declined_at IS NOT NULL) AS a) AS b GROUP BY reason"
