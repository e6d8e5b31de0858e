"""Small expression builders for the two SQL dialects a plan is written in:
Spark's, which runs it, and DuckDB's, which checks it."""

from __future__ import annotations


class Spark:
    name = "spark"

    def days(self, n: str) -> str:
        return f"make_dt_interval({n})"

    def hours(self, n: str) -> str:
        return f"make_dt_interval(0, {n})"

    def day_key(self, ts: str) -> str:
        return f"date_format({ts}, 'yyyyMMdd')"

    def day(self, ts: str) -> str:
        return f"to_date({ts})"

    def div(self, a: str, b: str) -> str:
        return f"(({a}) div ({b}))"

    def week(self, ts: str) -> str:
        return f"trunc({ts}, 'week')"

    def month(self, ts: str) -> str:
        return f"trunc({ts}, 'month')"

    def iso_week(self, ts: str) -> str:
        return f"concat(extract(yearofweek FROM {ts}), '-W', lpad(weekofyear({ts}), 2, '0'))"

    def diff(self, unit: str, a: str, b: str) -> str:
        """Whole units from a to b, cut off."""
        return f"timestampdiff({unit}, {a}, {b})"

    def disc(self, p: float, x: str) -> str:
        return f"percentile_disc({p}) WITHIN GROUP (ORDER BY {x})"

    def joined(self, x: str, n: int | None = None) -> str:
        """Distinct values in order, joined by a comma."""
        s = f"array_sort(collect_set({x}))"
        return f"array_join({s if n is None else f'slice({s}, 1, {n})'}, ',')"

    def top(self, x: str, by: str) -> str:
        return f"max_by({x}, {by})"

    def low(self, x: str, by: str) -> str:
        return f"min_by({x}, {by})"

    def big(self, x: str) -> str:
        return f"CAST({x} AS BIGINT)"

    def json_long(self, x: str, key: str) -> str:
        return f"CAST(get_json_object({x}, '$.{key}') AS BIGINT)"

    def like_re(self, x: str, pattern: str) -> str:
        return f"({x} RLIKE r'{pattern}')"

    def sha256(self, x: str) -> str:
        return f"sha2({x}, 256)"

    def explode_days(self, a: str, b: str) -> str:
        return f"explode(sequence({a}, {b}, INTERVAL 1 DAY))"

    def date(self, text: str) -> str:
        return f"DATE '{text}'"

    def ts(self, text: str) -> str:
        return f"TIMESTAMP_NTZ '{text}'"


class Duck(Spark):
    name = "duck"

    def days(self, n: str) -> str:
        return f"to_days(CAST({n} AS INTEGER))"

    def hours(self, n: str) -> str:
        return f"to_hours(CAST({n} AS INTEGER))"

    def day_key(self, ts: str) -> str:
        return f"strftime({ts}, '%Y%m%d')"

    def day(self, ts: str) -> str:
        return f"CAST({ts} AS DATE)"

    def div(self, a: str, b: str) -> str:
        return f"(({a}) // ({b}))"

    def week(self, ts: str) -> str:
        return f"CAST(date_trunc('week', {ts}) AS DATE)"

    def month(self, ts: str) -> str:
        return f"CAST(date_trunc('month', {ts}) AS DATE)"

    def iso_week(self, ts: str) -> str:
        return f"strftime({ts}, '%G-W%V')"

    def diff(self, unit: str, a: str, b: str) -> str:
        return f"date_sub('{unit.lower()}', {a}, {b})"

    def disc(self, p: float, x: str) -> str:
        return f"quantile_disc({x}, {p})"

    def joined(self, x: str, n: int | None = None) -> str:
        if n is None:
            return f"coalesce(string_agg(DISTINCT {x}, ',' ORDER BY {x}), '')"
        return f"coalesce(array_to_string(list_slice(list_sort(list(DISTINCT {x}) FILTER (WHERE {x} IS NOT NULL)), 1, {n}), ','), '')"

    def top(self, x: str, by: str) -> str:
        return f"arg_max({x}, {by})"

    def low(self, x: str, by: str) -> str:
        return f"arg_min({x}, {by})"

    def big(self, x: str) -> str:
        """count_if over nulls only is null here, and zero in Spark."""
        return f"CAST({f'coalesce({x}, 0)' if x.startswith('count_if') else x} AS BIGINT)"

    def json_long(self, x: str, key: str) -> str:
        return f"CAST(json_extract_string({x}, '$.{key}') AS BIGINT)"

    def like_re(self, x: str, pattern: str) -> str:
        return f"regexp_matches({x}, '{pattern}')"

    def sha256(self, x: str) -> str:
        return f"sha256({x})"

    def explode_days(self, a: str, b: str) -> str:
        return f"CAST(unnest(generate_series({a}, {b}, INTERVAL 1 DAY)) AS DATE)"

    def ts(self, text: str) -> str:
        return f"TIMESTAMP '{text}'"


SPARK, DUCK = Spark(), Duck()
