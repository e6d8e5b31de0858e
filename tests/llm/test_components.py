"""Components: no work once every node is beside its smallest."""

from importlib import import_module

import pytest

C = import_module("deliverylens.llm.components")


@pytest.mark.parametrize("edges, most", [([(0, k) for k in range(1, 40)] + [(50, 51)], 2), ([(k, k + 1) for k in range(40)], 40), ([(a, b) for a in range(9) for b in range(a)], 10), ([], 2)])
def test_rounds_end_with_the_stars(spark, monkeypatch, edges, most):
    made, plain = [], C.checkpoint
    monkeypatch.setattr(C, "checkpoint", lambda df: made.append(1) or plain(df))
    got = {r.node: r.component for r in C.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for e in edges for x in e}
    assert got == {x: 50 if x >= 50 else 0 for x in nodes}
    assert len(made) <= most
