"""Derived relations held against SQL that is written from the stored tables,
without the relations' own text: here a match shows that the rule is right."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .catalogue import runner

BODIES = {
    "x09_priced_calls": ("Calls with their cost at the price of their date.", "SELECT event_id, cost_nano, has_price, placeholder FROM priced"),
    "x11_cost_rollup": ("Costs by session: unknown unless every call has one.", "SELECT trace_id, calls, cost_nano, has_unpriced, has_placeholder FROM usage"),
    "x15_session_model": (
        "The model with most tokens of each session; ties go to the smaller name.",
        "SELECT trace_id, model_id, tokens FROM (SELECT *, row_number() OVER (PARTITION BY trace_id ORDER BY tokens DESC, model_id) AS nth FROM (SELECT trace_id, model_id, CAST(sum(tokens_in + tokens_out) AS BIGINT) AS tokens FROM calls WHERE tokens_in IS NOT NULL GROUP BY trace_id, model_id) AS a) AS b WHERE nth = 1",
    ),
    "x26_run_outcomes": ("Runs with their end, cost and counts.", "SELECT run_id, terminal_status, duration_s, run_count, cost_nano, gates, passed, failed, retries, tool_calls, tool_errors, corrections FROM fct_run"),
    "x39_generated_lines": ("New lines by request and those after its first review.", "SELECT pr_id, n_outputs, generated, after_review FROM rework"),
    "x42_assembled_outputs": ("Outputs with the reason and the state of their acceptance.", "SELECT output_id, acceptance_reason, acceptance_state FROM fct_output"),
    "x01_dedup_event": ("Deliveries without those that came again.", "SELECT event_id, event_time, ingested_at FROM ev"),
    "x02_run_started": ("Runs with their first start.", "SELECT run_id, started_at, trace_id, agent_name, starts FROM runs"),
    "x03_run_terminal": ("The first end of each run.", "SELECT run_id, ended_at, terminal_status FROM terminal"),
    "x06_session_counts": ("How many runs each session has.", "SELECT trace_id, run_count, first_at FROM sessions"),
    "x21_gate_rollup": ("Gates of each run by their last verdict.", "SELECT run_id, gates, passed, failed, unknown, retries FROM gate_rollup"),
    "x22_gate_final": ("The last attempt at each gate of a run.", "SELECT run_id, gate_name, verdict, attempt FROM gate_final"),
    "x31_output_raw": ("Outputs of the first claim of each line.", "SELECT output_id, pr_id, l_suppkey, lines_added, agent_name, committed_at FROM outputs"),
    "x41_run_context": ("The dimensions of a run that its outputs take over.", "SELECT run_id, trace_id, person_id, agent_name, skill_name, surface, link_method FROM runs"),
    "x44_output_fact": ("The output fact with its ratio and its acceptance.", "SELECT output_id, pr_id, agent_name, lines_added, quarantined, reused, rework_ratio, acceptance_state, acceptance_reason FROM fct_output"),
    "w03_first_claimant": ("The supplier that each output belongs to, and whether several claim its line.", "SELECT output_id, l_suppkey, quarantined FROM outputs"),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def one(name: str, doc: str, body: str) -> Callable[[SparkSession, str], DataFrame]:
        def plan(d: object) -> str:
            return body

        plan.__name__, plan.__doc__ = name, doc
        return runner(plan)

    return {name: one(name, *told) for name, told in BODIES.items()}


_EVENTS = """
e AS (SELECT event_id AS n, ts, user_id, event_type AS t, value, CAST(props->>'$.k' AS BIGINT) AS k, concat('ses_', user_id, '_', strftime(ts, '%Y%m%d')) AS ses, concat('run_', user_id, '_', strftime(ts, '%Y%m%d'), '_', CAST(floor(hour(ts) / 8) AS INT)) AS run FROM events),
c AS (SELECT n, ses, k % 5 AS m, CAST(ts AS DATE) >= DATE '2024-01-16' AS new, k % 7 <> 6 AS known, CAST(floor(value * 100) AS BIGINT) AS tin, CAST(floor(value * 10) AS BIGINT) AS tout, CASE WHEN k % 9 = 4 THEN 0 ELSE CAST(floor(value * 30) AS BIGINT) END AS tc FROM e WHERE t = 'purchase'),
p AS (SELECT *, CASE WHEN NOT known THEN NULL WHEN m = 0 AND new THEN (tin - tc) * 2500 + tout * 12000 + tc * 250 WHEN m = 0 THEN (tin - tc) * 3000 + tout * 15000 + tc * 300 WHEN m = 1 AND new THEN (tin - tc) * 1000 + tout * 5000 + tc * 100 WHEN m = 1 THEN (tin - tc) * 800 + tout * 4000 + tc * 80 WHEN m = 2 AND tc = 0 THEN tin * 500 + tout * 1500 END AS cost FROM c),
u AS (SELECT ses, count(*) AS calls, CASE WHEN count(cost) = count(*) THEN sum(cost)::BIGINT END AS cost, max(m >= 3) AS unpriced, max(m = 3) AS placeholder FROM p GROUP BY ses),
r AS (SELECT run, ses, min(ts) AS began FROM e WHERE t = 'signup' GROUP BY 1, 2)"""

_OUTPUTS = """
l AS (SELECT DISTINCT * FROM lineitem),
q AS (SELECT l_orderkey, l_linenumber, count(DISTINCT l_suppkey) > 1 AS several FROM l GROUP BY 1, 2),
o AS (SELECT l.*, several, concat_ws('-', l_orderkey, l_linenumber, l_partkey) AS output_id, o_orderdate + l_linenumber * INTERVAL 24 HOUR AS committed, CASE WHEN l_orderkey % 4 <> 0 THEN o_orderdate + (l_orderkey % 72 + 1) * INTERVAL 1 HOUR END AS reviewed, o_orderdate, o_orderstatus
  FROM l JOIN q USING (l_orderkey, l_linenumber) JOIN orders ON l_orderkey = o_orderkey
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey ORDER BY l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1),
g AS (SELECT l_orderkey AS pr_id, count(*) AS n_outputs, coalesce(sum(CAST(l_quantity AS BIGINT)) FILTER (l_returnflag <> 'R'), 0)::BIGINT AS generated, CASE WHEN max(l_orderkey % 4) > 0 THEN coalesce(sum(CAST(l_quantity AS BIGINT)) FILTER (l_returnflag <> 'R' AND committed > reviewed), 0)::BIGINT END AS after_review FROM o GROUP BY 1)"""

_STATES = f"""
WITH {_OUTPUTS}, s AS (
  SELECT o.*, generated, after_review, CASE
    WHEN several THEN 'quarantined' WHEN l_returnflag = 'R' THEN 'reused'
    WHEN o_orderstatus = 'F' AND l_orderkey % 17 = 0 AND datesub('day', o_orderdate + (l_orderkey % 240 + 80) * INTERVAL 1 HOUR, o_orderdate + (l_orderkey % 60 + 15) * INTERVAL 1 DAY) <= 30 THEN 'reverted'
    WHEN o_orderstatus = 'P' THEN 'declined'
    WHEN committed > TIMESTAMP '2001-09-01' THEN CASE WHEN o_orderdate <= TIMESTAMP '2001-09-01' - INTERVAL 8 DAY THEN 'never_committed' ELSE 'awaiting_commit' END
    WHEN o_orderstatus <> 'F' THEN 'unmerged'
    WHEN o_orderdate + (l_orderkey % 240 + 80) * INTERVAL 1 HOUR > TIMESTAMP '2001-09-01' - INTERVAL 30 DAY THEN 'immature'
    WHEN generated = 0 THEN 'ratio_undefined' WHEN 4 * coalesce(after_review, 0) > generated THEN 'over_ratio' ELSE 'under_ratio' END AS why
  FROM o JOIN g ON l_orderkey = pr_id),
a AS (SELECT *, CASE why WHEN 'over_ratio' THEN 'reworked' WHEN 'under_ratio' THEN 'accepted' WHEN 'ratio_undefined' THEN 'accepted' WHEN 'quarantined' THEN why WHEN 'reused' THEN why WHEN 'reverted' THEN 'rejected' WHEN 'declined' THEN 'rejected' WHEN 'never_committed' THEN 'rejected' ELSE 'in_flight' END AS state FROM s)"""

ORACLE_SQL = {
    "x01_dedup_event": "SELECT concat('evt_', event_id) AS event_id, ts AS event_time, ts + (event_id % 11) * INTERVAL 1 DAY AS ingested_at FROM events",
    "x02_run_started": f"WITH {_EVENTS} SELECT run AS run_id, min(ts) AS started_at, ses AS trace_id, concat('agent_', user_id % 7) AS agent_name, count(*) AS starts FROM e WHERE t = 'signup' GROUP BY run, ses, user_id",
    "x03_run_terminal": f"WITH {_EVENTS} SELECT run AS run_id, min(ts) AS ended_at, CASE arg_min(n, ts) % 11 WHEN 0 THEN 'failed' WHEN 1 THEN 'timeout' WHEN 2 THEN 'abandoned' ELSE 'success' END AS terminal_status FROM e WHERE t = 'error' AND k >= 50 GROUP BY run",
    "x06_session_counts": f"WITH {_EVENTS} SELECT ses AS trace_id, count(*) AS run_count, min(began) AS first_at FROM r GROUP BY ses",
    "x21_gate_rollup": f"WITH {_EVENTS}, last AS (SELECT run, k % 5 AS gate, arg_max(n, (k % 4, ts)) AS n, max(k % 4) AS tries FROM e WHERE t = 'error' GROUP BY 1, 2), v AS (SELECT run, tries, CASE WHEN n % 9 = 0 THEN NULL ELSE n % 9 >= 4 END AS good FROM last) SELECT run AS run_id, count(*) AS gates, CASE WHEN count(good) > 0 THEN count(*) FILTER (good) END AS passed, CASE WHEN count(good) > 0 THEN count(*) FILTER (NOT good) END AS failed, count(*) FILTER (good IS NULL) AS unknown, sum(tries)::BIGINT AS retries FROM v GROUP BY run",
    "x22_gate_final": f"WITH {_EVENTS}, last AS (SELECT run, k % 5 AS gate, arg_max(n, (k % 4, ts)) AS n, max(k % 4) AS attempt FROM e WHERE t = 'error' GROUP BY 1, 2) SELECT run AS run_id, ['build', 'test', 'lint', 'secrets', 'coverage'][gate + 1] AS gate_name, CASE WHEN n % 9 = 0 THEN NULL WHEN n % 9 < 4 THEN 'fail' ELSE 'pass' END AS verdict, attempt FROM last",
    "x31_output_raw": f"WITH {_OUTPUTS} SELECT output_id, l_orderkey AS pr_id, l_suppkey, CAST(l_quantity AS BIGINT) AS lines_added, concat('agent_', l_suppkey % 7) AS agent_name, committed AS committed_at FROM o",
    "x41_run_context": f"WITH {_EVENTS} SELECT run AS run_id, ses AS trace_id, concat('p_', user_id) AS person_id, concat('agent_', user_id % 7) AS agent_name, CASE WHEN user_id % 4 > 0 THEN concat('skill_', user_id % 4) END AS skill_name, ['copilot-cli', 'vscode-copilot-chat', 'headless'][user_id % 3 + 1] AS surface, CASE WHEN user_id % 5 = 0 THEN 'heuristic' ELSE 'explicit' END AS link_method FROM e WHERE t = 'signup' GROUP BY run, ses, user_id",
    "x44_output_fact": f"{_STATES} SELECT output_id, l_orderkey AS pr_id, concat('agent_', l_suppkey % 7) AS agent_name, CAST(l_quantity AS BIGINT) AS lines_added, several AS quarantined, l_returnflag = 'R' AS reused, CAST(after_review AS DOUBLE) / nullif(generated, 0) AS rework_ratio, state AS acceptance_state, why AS acceptance_reason FROM a",
    "x09_priced_calls": f"WITH {_EVENTS} SELECT concat('evt_', n) AS event_id, cost AS cost_nano, m < 3 AS has_price, m = 3 AS placeholder FROM p",
    "x11_cost_rollup": f"WITH {_EVENTS} SELECT ses AS trace_id, calls, cost AS cost_nano, unpriced AS has_unpriced, placeholder AS has_placeholder FROM u",
    "x15_session_model": f"WITH {_EVENTS}, a AS (SELECT ses, m, sum(tin + tout)::BIGINT AS tokens FROM c WHERE known GROUP BY 1, 2) SELECT ses AS trace_id, concat('m_', min(m)) AS model_id, tokens FROM a WHERE tokens = (SELECT max(tokens) FROM a b WHERE b.ses = a.ses) GROUP BY ses, tokens",
    "x26_run_outcomes": f"""
WITH {_EVENTS},
fin AS (SELECT run, min(ts) AS done, arg_min(n, ts) AS mark FROM e WHERE t = 'error' AND k >= 50 GROUP BY 1),
last AS (SELECT run, k % 5 AS gate, arg_max(n, (k % 4, ts)) AS n FROM e WHERE t = 'error' GROUP BY 1, 2),
gt AS (SELECT last.run, count(*) AS gates, count(*) FILTER (last.n % 9 >= 4) AS good, count(*) FILTER (last.n % 9 BETWEEN 1 AND 3) AS poor, sum(e.k % 4)::BIGINT AS retries FROM last JOIN e ON e.n = last.n GROUP BY 1),
tl AS (SELECT run, count(*) AS calls, CASE WHEN count(*) FILTER (n % 8 > 0) > 0 THEN count(*) FILTER (n % 8 = 1) END AS errors FROM e WHERE t = 'view' GROUP BY 1),
ho AS (SELECT run, count(*) FILTER (k % 4 = 1) AS corrections FROM e WHERE t = 'click' GROUP BY 1)
SELECT run AS run_id, CASE WHEN done IS NULL THEN 'in_flight' WHEN mark % 11 = 0 THEN 'failed' WHEN mark % 11 = 1 THEN 'timeout' WHEN mark % 11 = 2 THEN 'abandoned' ELSE 'success' END AS terminal_status,
  CAST(trunc((epoch_us(done) - epoch_us(began)) / 1e6) AS BIGINT) AS duration_s, runs AS run_count, CASE WHEN runs = 1 THEN cost END AS cost_nano, gates, CASE WHEN good + poor > 0 THEN good END AS passed, CASE WHEN good + poor > 0 THEN poor END AS failed, retries, tl.calls AS tool_calls, errors AS tool_errors, coalesce(corrections, 0) AS corrections
FROM (SELECT *, count(*) OVER (PARTITION BY ses) AS runs FROM r) LEFT JOIN fin USING (run) LEFT JOIN u USING (ses) LEFT JOIN gt USING (run) LEFT JOIN tl USING (run) LEFT JOIN ho USING (run)""",
    "x39_generated_lines": f"WITH {_OUTPUTS} SELECT * FROM g",
    "x42_assembled_outputs": f"""
WITH {_OUTPUTS}, s AS (
  SELECT output_id, CASE
    WHEN several THEN 'quarantined' WHEN l_returnflag = 'R' THEN 'reused'
    WHEN o_orderstatus = 'F' AND l_orderkey % 17 = 0 AND datesub('day', o_orderdate + (l_orderkey % 240 + 80) * INTERVAL 1 HOUR, o_orderdate + (l_orderkey % 60 + 15) * INTERVAL 1 DAY) <= 30 THEN 'reverted'
    WHEN o_orderstatus = 'P' THEN 'declined'
    WHEN committed > TIMESTAMP '2001-09-01' THEN CASE WHEN o_orderdate <= TIMESTAMP '2001-09-01' - INTERVAL 8 DAY THEN 'never_committed' ELSE 'awaiting_commit' END
    WHEN o_orderstatus <> 'F' THEN 'unmerged'
    WHEN o_orderdate + (l_orderkey % 240 + 80) * INTERVAL 1 HOUR > TIMESTAMP '2001-09-01' - INTERVAL 30 DAY THEN 'immature'
    WHEN generated = 0 THEN 'ratio_undefined' WHEN 4 * coalesce(after_review, 0) > generated THEN 'over_ratio' ELSE 'under_ratio' END AS why
  FROM o JOIN g ON l_orderkey = pr_id)
SELECT output_id, why AS acceptance_reason, CASE why WHEN 'over_ratio' THEN 'reworked' WHEN 'under_ratio' THEN 'accepted' WHEN 'ratio_undefined' THEN 'accepted' WHEN 'quarantined' THEN why WHEN 'reused' THEN why WHEN 'reverted' THEN 'rejected' WHEN 'declined' THEN 'rejected' WHEN 'never_committed' THEN 'rejected' ELSE 'in_flight' END AS acceptance_state FROM s""",
    "w03_first_claimant": "SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey) AS output_id, min(l_suppkey) AS l_suppkey, any_value(several) AS quarantined FROM lineitem JOIN (SELECT l_orderkey, l_linenumber, min(l_suppkey) < max(l_suppkey) AS several FROM lineitem GROUP BY 1, 2) USING (l_orderkey, l_linenumber) JOIN orders ON l_orderkey = o_orderkey GROUP BY 1",
}
