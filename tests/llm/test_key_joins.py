"""Keys made by an explode are many times what Spark takes them for: no side of their join is broadcast."""

from deliverylens.llm import simhash


def test_block_keys_are_not_broadcast(spark):
    rows = spark.createDataFrame([(x << 20,) for x in range(2000)], "fp long")
    found = simhash.links(rows, max_bits=2)
    pairs = {(r.a >> 20, r.b >> 20) for r in found.collect()}
    assert pairs == {(a, b) for a in range(2000) for b in [a ^ (1 << j) ^ (1 << k) for j in range(11) for k in range(11)] + [a ^ (1 << j) for j in range(11)] if a < b < 2000}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
