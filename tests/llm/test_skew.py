"""Hot keys are split: what is joined back to them lies in a checkpoint."""

from pyspark.sql import functions as F

from deliverylens.llm import line_dedup

CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.shuffle.partitions": "8",
}


def test_a_window_that_a_third_of_all_lines_share_is_split(spark):
    before = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 300_000, numPartitions=12).select(F.col("id").alias("doc_id"), F.lit(0).alias("pos"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.xxhash64("id")).alias("h1"), F.lit(1).cast("long").alias("h2"))
        out = line_dedup.later_windows(rows)
        assert out.select(F.max("doc_id")).first()[0] == 299_997 and out.count() == 99_999
        out.write.format("noop").mode("overwrite").save()
        counted = out.groupBy("pos").agg(F.count("*"))
        counted.collect()
        assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
