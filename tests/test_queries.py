"""Queries of files, facts and derived relations against the SQL beside them, on the smallest tables."""

import os

import duckdb
import pytest

from deliverylens.operators import facts, report_queries, rule_queries, state_queries
from deliverylens.plans import apart
from deliverylens.sources import queries as sources
from tests.conftest import DATA

SF = f"{DATA}/sf0.001"
SQL = facts.ORACLE_SQL | sources.ORACLE_SQL | apart.ORACLE_SQL | rule_queries.ORACLE_SQL | report_queries.ORACLE_SQL | state_queries.ORACLE_SQL
BOTH = {n: (f, SQL[n]) for n, f in (facts.QUERIES | sources.QUERIES | apart.queries() | rule_queries.QUERIES | report_queries.QUERIES | state_queries.QUERIES).items()}


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    plain = lambda x: round(x, 6) if isinstance(x, float) else x
    return sorted(columns), sorted([tuple(plain(r[k]) for k in order) for r in rows], key=str)


@pytest.mark.parametrize("name", sorted(BOTH))
def test_query_equals_its_sql(spark, name):
    query, sql = BOTH[name]
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    got = query(spark, SF)
    want = con.execute(sql)
    assert _rows(got.columns, [tuple(r) for r in got.collect()]) == _rows([d[0] for d in want.description], want.fetchall())
