"""Base relations: the telemetry domain as views over the stored tables.

Each relation is a function of a dialect that returns SQL; ``chain`` puts the
ones a plan needs in front of it. Money is kept in whole nano-dollars, so sums
are exact in any order.
"""

from __future__ import annotations

import re

from .dialect import Spark

#: Fixed clocks of the stored data; no plan reads the current time.
EVENTS_AS_OF, ORDERS_AS_OF = "2024-01-31 00:00:00", "2001-09-01 00:00:00"


def named(d: Spark, ingested_at: str) -> str:
    """The columns of stored events in the domain's names."""
    return f"""concat('evt_', event_id) AS event_id, ts AS event_time, {ingested_at} AS ingested_at, event_id AS n,
  user_id, concat('p_', user_id) AS person_id, concat('ses_', user_id, '_', {d.day_key('ts')}) AS trace_id,
  concat('run_', user_id, '_', {d.day_key('ts')}, '_', {d.div('hour(ts)', '8')}) AS run_id,
  CASE event_type WHEN 'signup' THEN 'run.started' WHEN 'view' THEN 'tool.call' WHEN 'click' THEN 'human.turn' WHEN 'purchase' THEN 'model.call' ELSE 'gate.evaluated' END AS event_type,
  {d.json_long('props', 'k')} AS k, value,
  concat('agent_', user_id % 7) AS agent_name, CASE WHEN user_id % 4 <> 0 THEN concat('skill_', user_id % 4) END AS skill_name,
  CASE user_id % 3 WHEN 0 THEN 'copilot-cli' WHEN 1 THEN 'vscode-copilot-chat' ELSE 'headless' END AS surface,
  CASE WHEN user_id % 5 = 0 THEN 'heuristic' ELSE 'explicit' END AS link_method"""


def ev0(d: Spark) -> str:
    """One row an event, in the domain's names."""
    return f"""
SELECT {named(d, f"ts + {d.days('event_id % 11')}")}
FROM events"""


def delivered(d: Spark) -> str:
    """Events as they arrive: one in ten is delivered again, a day later."""
    return f"SELECT * FROM ev0 UNION ALL SELECT * REPLACE (ingested_at + {d.days('1')} AS ingested_at) FROM ev0 WHERE n % 10 = 0" if d.name == "duck" else f"""
SELECT * FROM ev0 UNION ALL
SELECT event_id, event_time, ingested_at + {d.days('1')} AS ingested_at, n, user_id, person_id, trace_id, run_id, event_type, k, value, agent_name, skill_name, surface, link_method FROM ev0 WHERE n % 10 = 0"""


def ev(d: Spark) -> str:
    """Deliveries without re-deliveries: of one event_id the earliest stays. In Spark the
    stored columns are shuffled, and what follows from them is worked out for the rows that stay."""
    if d.name == "duck":
        return """
SELECT event_id, event_time, ingested_at, n, user_id, person_id, trace_id, run_id, event_type, k, value, agent_name, skill_name, surface, link_method
FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY coalesce(ingested_at, event_time), event_time) AS nth FROM delivered) AS x WHERE nth = 1"""
    stored, arrived = "event_id, ts, user_id, event_type, value, props", f"ts + {d.days('event_id % 11')}"
    return f"""
SELECT {named(d, 'arrived')}
FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY coalesce(arrived, ts), ts) AS nth FROM (
  SELECT {stored}, {arrived} AS arrived FROM events UNION ALL SELECT {stored}, {arrived} + {d.days('1')} AS arrived FROM events WHERE event_id % 10 = 0) AS y) AS x WHERE nth = 1"""


def tools(d: Spark) -> str:
    return """
SELECT *, concat('tool_', k % 6) AS tool_name, concat('kind_', k % 5) AS tool_kind,
  CASE n % 8 WHEN 0 THEN NULL WHEN 1 THEN 'error' ELSE 'ok' END AS status FROM ev WHERE event_type = 'tool.call'"""


def turns(d: Spark) -> str:
    return """
SELECT *, CASE k % 4 WHEN 0 THEN 'clarification' WHEN 1 THEN 'correction' WHEN 2 THEN 'approval' ELSE 'rejection' END AS turn_kind
FROM ev WHERE event_type = 'human.turn'"""


def gates(d: Spark) -> str:
    return """
SELECT *, CASE k % 5 WHEN 0 THEN 'build' WHEN 1 THEN 'test' WHEN 2 THEN 'lint' WHEN 3 THEN 'secrets' ELSE 'coverage' END AS gate_name,
  CASE WHEN n % 9 = 0 THEN NULL WHEN n % 9 < 4 THEN 'fail' ELSE 'pass' END AS verdict, k % 4 AS attempt
FROM ev WHERE event_type = 'gate.evaluated'"""


def calls(d: Spark) -> str:
    """Model calls; no token count is known where k % 7 = 6, none of cached tokens where k % 9 = 4."""
    return f"""
SELECT *, concat('m_', k % 5) AS model_id, {d.day('event_time')} AS call_date,
  CASE WHEN k % 7 <> 6 THEN {d.big('floor(value * 100)')} END AS tokens_in,
  CASE WHEN k % 7 <> 6 THEN {d.big('floor(value * 10)')} END AS tokens_out,
  CASE WHEN k % 7 <> 6 AND k % 9 <> 4 THEN {d.big('floor(value * 30)')} END AS tokens_cached
FROM ev WHERE event_type = 'model.call'"""


def prices(d: Spark) -> str:
    """The price book: micro-dollars for 1,000 tokens, by effective date."""
    return f"""
SELECT * FROM (VALUES
  ('m_0', {d.date('2023-01-01')}, {d.date('2024-01-15')}, CAST(3000 AS BIGINT), CAST(15000 AS BIGINT), CAST(300 AS BIGINT), false),
  ('m_0', {d.date('2024-01-16')}, CAST(NULL AS DATE), 2500, 12000, 250, false),
  ('m_1', {d.date('2023-01-01')}, {d.date('2024-01-15')}, 800, 4000, 80, false),
  ('m_1', {d.date('2024-01-16')}, CAST(NULL AS DATE), 1000, 5000, 100, false),
  ('m_2', {d.date('2023-06-01')}, CAST(NULL AS DATE), 500, 1500, CAST(NULL AS BIGINT), false),
  ('m_3', {d.date('2023-06-01')}, CAST(NULL AS DATE), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), true)
) AS p(model_id, effective_from, effective_to, p_in, p_out, p_cached, placeholder)"""


def priced(d: Spark) -> str:
    """Calls with the price of their date: cost is null if any part can't be priced.
    No count of cached tokens means that none were."""
    return """
SELECT c.*, p.p_in IS NOT NULL AS has_price, coalesce(p.placeholder, false) AS placeholder,
  greatest(c.tokens_in - coalesce(c.tokens_cached, 0), 0) * p.p_in + c.tokens_out * p.p_out
    + CASE WHEN coalesce(c.tokens_cached, 0) = 0 THEN 0 ELSE c.tokens_cached * p.p_cached END AS cost_nano
FROM calls c LEFT JOIN prices p ON c.model_id = p.model_id AND c.call_date BETWEEN p.effective_from AND coalesce(p.effective_to, DATE '9999-12-31')"""


def runs(d: Spark) -> str:
    """One row a run: its earliest start and its attributes."""
    return """
SELECT run_id, min(event_time) AS started_at, min(trace_id) AS trace_id, min(person_id) AS person_id, min(user_id) AS user_id, min(agent_name) AS agent_name,
  min(skill_name) AS skill_name, min(surface) AS surface, min(link_method) AS link_method, count(*) AS starts
FROM ev WHERE event_type = 'run.started' GROUP BY run_id"""


def sessions(d: Spark) -> str:
    """How many runs each session has."""
    return "SELECT trace_id, count(DISTINCT run_id) AS run_count, min(started_at) AS first_at FROM runs GROUP BY trace_id"


def usage(d: Spark) -> str:
    """Session totals; the cost is null unless every call can be priced."""
    return f"""
SELECT trace_id, count(*) AS calls, {d.big('sum(tokens_in)')} AS tokens_in, {d.big('sum(tokens_out)')} AS tokens_out, {d.big('sum(tokens_cached)')} AS tokens_cached,
  CASE WHEN bool_and(cost_nano IS NOT NULL) THEN {d.big('sum(cost_nano)')} END AS cost_nano, bool_or(NOT has_price) AS has_unpriced, bool_or(placeholder) AS has_placeholder
FROM priced GROUP BY trace_id"""


def gate_final(d: Spark) -> str:
    """The last attempt of each run and gate."""
    return """
SELECT run_id, gate_name, verdict, attempt FROM (
  SELECT *, row_number() OVER (PARTITION BY run_id, gate_name ORDER BY attempt DESC, event_time DESC, event_id) AS nth FROM gates) AS x WHERE nth = 1"""


def gate_rollup(d: Spark) -> str:
    """Verdicts by run; null where no gate has one."""
    return f"""
SELECT run_id, count(*) AS gates, CASE WHEN count(verdict) > 0 THEN {d.big("count_if(verdict = 'pass')")} END AS passed,
  CASE WHEN count(verdict) > 0 THEN {d.big("count_if(verdict = 'fail')")} END AS failed, {d.big('count_if(verdict IS NULL)')} AS unknown, {d.big('sum(attempt)')} AS retries
FROM gate_final GROUP BY run_id"""


def tool_rollup(d: Spark) -> str:
    return f"""
SELECT run_id, count(*) AS tool_calls, CASE WHEN count(status) > 0 THEN {d.big("count_if(status = 'error')")} END AS tool_errors, count(status) AS tool_known
FROM tools GROUP BY run_id"""


def turn_rollup(d: Spark) -> str:
    return f"""
SELECT run_id, count(*) AS turns, {d.big("count_if(turn_kind = 'correction')")} AS corrections, {d.big("count_if(turn_kind = 'rejection')")} AS rejections,
  {d.big("count_if(turn_kind = 'approval')")} AS approvals, {d.big("count_if(turn_kind = 'clarification')")} AS clarifications
FROM turns GROUP BY run_id"""


def terminal(d: Spark) -> str:
    """The first terminal event of a run, taken from its last gate event."""
    return """
SELECT run_id, ended_at, CASE mark % 11 WHEN 0 THEN 'failed' WHEN 1 THEN 'timeout' WHEN 2 THEN 'abandoned' ELSE 'success' END AS terminal_status
FROM (SELECT run_id, event_time AS ended_at, n AS mark, row_number() OVER (PARTITION BY run_id ORDER BY event_time, event_id) AS nth
      FROM ev WHERE event_type = 'gate.evaluated' AND k >= 50) AS x WHERE nth = 1"""


def fct_run(d: Spark) -> str:
    """The run fact: a star of rollups; session cost only where a session has one run."""
    return f"""
SELECT r.run_id, r.started_at, t.ended_at, {d.day('r.started_at')} AS run_date, r.trace_id, r.person_id, r.user_id, r.agent_name, r.skill_name, r.surface, r.link_method,
  coalesce(t.terminal_status, 'in_flight') AS terminal_status, {d.diff('SECOND', 'r.started_at', 't.ended_at')} AS duration_s, s.run_count, s.run_count = 1 AS cost_attributable,
  CASE WHEN s.run_count = 1 THEN u.tokens_in END AS tokens_in, CASE WHEN s.run_count = 1 THEN u.tokens_out END AS tokens_out,
  CASE WHEN s.run_count = 1 THEN u.cost_nano END AS cost_nano, u.has_unpriced, u.has_placeholder,
  g.gates, g.passed, g.failed, g.unknown, g.retries, o.tool_calls, o.tool_errors, o.tool_known,
  coalesce(h.turns, 0) AS turns, coalesce(h.corrections, 0) AS corrections, coalesce(h.rejections, 0) AS rejections, coalesce(h.approvals, 0) AS approvals
FROM runs r JOIN sessions s ON r.trace_id = s.trace_id LEFT JOIN terminal t ON r.run_id = t.run_id LEFT JOIN usage u ON r.trace_id = u.trace_id
LEFT JOIN gate_rollup g ON r.run_id = g.run_id LEFT JOIN tool_rollup o ON r.run_id = o.run_id LEFT JOIN turn_rollup h ON r.run_id = h.run_id"""


def run_cost(d: Spark) -> str:
    """Agent and cost of each run as the run fact has them, without what else the fact joins."""
    return """
SELECT r.agent_name, CASE WHEN r.run_count = 1 THEN u.cost_nano END AS cost_nano
FROM (SELECT *, count(run_id) OVER (PARTITION BY trace_id) AS run_count FROM runs WHERE trace_id IS NOT NULL) AS r LEFT JOIN usage u ON r.trace_id = u.trace_id"""


def prs(d: Spark) -> str:
    """The pull request fact over orders."""
    t = "CAST(o_orderdate AS TIMESTAMP)" if d.name == "duck" else "CAST(o_orderdate AS TIMESTAMP_NTZ)"
    return f"""
SELECT o_orderkey AS pr_id, concat('ws/repo', o_custkey % 10) AS repo, o_custkey AS author, created_on, o_orderstatus AS st,
  CASE WHEN o_orderkey % 4 <> 0 THEN created_on + {d.hours('o_orderkey % 72 + 1')} END AS first_review_at,
  CASE WHEN o_orderstatus = 'F' THEN created_on + {d.hours('o_orderkey % 240 + 80')} END AS merged_at,
  CASE WHEN o_orderstatus = 'P' THEN created_on + {d.hours('o_orderkey % 120 + 80')} END AS declined_at,
  CASE WHEN o_orderstatus = 'F' AND o_orderkey % 17 = 0 THEN created_on + {d.days('o_orderkey % 60 + 15')} END AS reverted_at,
  o_orderkey % 29 = 0 AS is_draft, o_orderkey % 31 = 0 AS is_bot_only
FROM (SELECT *, {t} AS created_on FROM orders) AS o"""


def claims(d: Spark) -> str:
    """Distinct output claims: one row an (order, line, part, supplier, ...) group."""
    return "SELECT DISTINCT * FROM lineitem"


def outputs(d: Spark) -> str:
    """Outputs: the first claim of each (order, line, part); several suppliers on one line quarantine it.
    In Spark all of it follows from one shuffle by order, and claims needn't be made distinct first:
    a repeated claim is neither another first one nor another supplier."""
    if d.name == "duck":
        return f"""
SELECT x.*, q.suppliers > 1 AS quarantined, p.created_on + {d.hours('x.l_linenumber * 24')} AS committed_at
FROM (SELECT l_orderkey AS pr_id, l_linenumber, l_partkey, l_suppkey, concat_ws('-', l_orderkey, l_linenumber, l_partkey) AS output_id, {d.big('l_quantity')} AS lines_added,
        l_returnflag = 'R' AS reused, concat('agent_', l_suppkey % 7) AS agent_name, l_linestatus,
        row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey ORDER BY l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS nth FROM claims) AS x
JOIN (SELECT l_orderkey, l_linenumber, count(DISTINCT l_suppkey) AS suppliers FROM claims GROUP BY l_orderkey, l_linenumber) AS q
  ON x.pr_id = q.l_orderkey AND x.l_linenumber = q.l_linenumber
JOIN prs p ON x.pr_id = p.pr_id WHERE nth = 1"""
    return f"""
SELECT x.l_orderkey AS pr_id, x.l_linenumber, x.l_partkey, x.l_suppkey, concat_ws('-', x.l_orderkey, x.l_linenumber, x.l_partkey) AS output_id, {d.big('x.l_quantity')} AS lines_added,
  x.l_returnflag = 'R' AS reused, concat('agent_', x.l_suppkey % 7) AS agent_name, x.l_linestatus, x.nth, x.several AS quarantined, p.created_on + {d.hours('x.l_linenumber * 24')} AS committed_at
FROM (SELECT *, coalesce(min(l_suppkey) OVER (PARTITION BY l_orderkey, l_linenumber) < max(l_suppkey) OVER (PARTITION BY l_orderkey, l_linenumber), false) AS several
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey ORDER BY l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS nth
    FROM (SELECT * FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL DISTRIBUTE BY l_orderkey) AS c) AS n) AS x
JOIN prs p ON x.l_orderkey = p.pr_id WHERE x.nth = 1"""


def rework(d: Spark) -> str:
    """Lines before and after the first review, by pull request; null if nobody reviewed."""
    return f"""
SELECT o.pr_id, count(*) AS n_outputs, {d.big('sum(CASE WHEN NOT o.reused THEN o.lines_added ELSE 0 END)')} AS generated,
  CASE WHEN min(p.first_review_at) IS NOT NULL THEN {d.big('sum(CASE WHEN o.committed_at > p.first_review_at AND NOT o.reused THEN o.lines_added ELSE 0 END)')} END AS after_review
FROM outputs o JOIN prs p ON o.pr_id = p.pr_id GROUP BY o.pr_id"""


def fct_output(d: Spark) -> str:
    """The output fact with its acceptance state: the order of the branches is the rule. In Spark
    rework is summed by window over the same rows, so that outputs are read once and not kept."""
    as_of = d.ts(ORDERS_AS_OF)
    text = f"""
SELECT y.*, CASE WHEN acceptance_reason IN ('awaiting_commit', 'no_pull_request', 'unmerged', 'immature') THEN 'in_flight'
    WHEN acceptance_reason IN ('under_ratio', 'ratio_undefined') THEN 'accepted' WHEN acceptance_reason = 'over_ratio' THEN 'reworked'
    WHEN acceptance_reason = 'reused' THEN 'reused' WHEN acceptance_reason = 'quarantined' THEN 'quarantined' ELSE 'rejected' END AS acceptance_state
FROM (
  SELECT o.output_id, o.pr_id, o.agent_name, o.lines_added, o.quarantined, o.reused, o.committed_at, p.created_on, p.merged_at, p.repo, p.is_draft, p.is_bot_only,
    CAST(w.after_review AS DOUBLE) / nullif(w.generated, 0) AS rework_ratio,
    CASE WHEN o.quarantined THEN 'quarantined' WHEN o.reused THEN 'reused'
      WHEN p.reverted_at IS NOT NULL AND {d.diff('DAY', 'p.merged_at', 'p.reverted_at')} <= 30 THEN 'reverted'
      WHEN p.declined_at IS NOT NULL THEN 'declined'
      WHEN o.committed_at > {as_of} AND {d.diff('DAY', 'p.created_on', as_of)} > 7 THEN 'never_committed'
      WHEN o.committed_at > {as_of} THEN 'awaiting_commit'
      WHEN p.merged_at IS NULL THEN 'unmerged'
      WHEN {d.diff('DAY', 'p.merged_at', as_of)} < 30 THEN 'immature'
      WHEN coalesce(w.after_review, 0) * 1.0 / nullif(w.generated, 0) > 0.25 THEN 'over_ratio'
      WHEN coalesce(w.after_review, 0) * 1.0 / nullif(w.generated, 0) <= 0.25 THEN 'under_ratio' ELSE 'ratio_undefined' END AS acceptance_reason
  FROM outputs o JOIN prs p ON o.pr_id = p.pr_id LEFT JOIN rework w ON o.pr_id = w.pr_id) AS y"""
    if d.name == "duck":
        return text
    over = "OVER (PARTITION BY o.pr_id)"
    rows = f"""(
    SELECT o.*, p.created_on, p.merged_at, p.reverted_at, p.declined_at, p.repo, p.is_draft, p.is_bot_only, {d.big(f'sum(CASE WHEN NOT o.reused THEN o.lines_added ELSE 0 END) {over}')} AS generated,
      CASE WHEN min(p.first_review_at) {over} IS NOT NULL THEN {d.big(f'sum(CASE WHEN o.committed_at > p.first_review_at AND NOT o.reused THEN o.lines_added ELSE 0 END) {over}')} END AS after_review
    FROM outputs o JOIN prs p ON o.pr_id = p.pr_id) AS z) AS y"""
    return re.sub(r"\b[opw]\.", "z.", text.rpartition("FROM outputs")[0]) + "FROM " + rows


def people(d: Spark) -> str:
    """People with the team of their nation and the project of its region."""
    return """
SELECT c.c_custkey, c.c_name, n.n_name AS team, r.r_name AS project FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey"""


def cases(d: Spark) -> str:
    """The test case fact over parts."""
    return """
SELECT p_partkey AS case_id, CASE p_size % 4 WHEN 0 THEN 'Automated' WHEN 1 THEN 'To Be Automated' WHEN 2 THEN NULL ELSE 'Manual' END AS automation_status,
  CASE WHEN p_brand LIKE 'Brand#1%' THEN 'P1' WHEN p_brand LIKE 'Brand#2%' THEN 'P2' WHEN p_brand LIKE 'Brand#3%' THEN 'P3' ELSE 'P4' END AS priority, p_size % 13 = 0 AS archived, p_type AS folder
FROM part"""


RELATIONS = {f.__name__: f for f in (ev0, delivered, ev, tools, turns, gates, calls, prices, priced, runs, sessions, usage, gate_final, gate_rollup, tool_rollup, turn_rollup, terminal, fct_run, run_cost, prs, claims, outputs, rework, fct_output, people, cases)}


def parts(d: Spark, body: str) -> dict[str, str]:
    """The relations that ``body`` names, and those they name, lower ones first."""
    done: dict[str, str] = {}

    def need(text: str) -> None:
        for name, relation in RELATIONS.items():
            if name not in done and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                sql = relation(d)
                need(sql)
                done[name] = sql

    need(body)
    return done


def chain(d: Spark, body: str) -> str:
    """``body`` with the relations that it needs before it."""
    done = parts(d, body)
    return ("WITH " + ",\n".join(f"{k} AS ({v})" for k, v in done.items()) + "\n" if done else "") + body
