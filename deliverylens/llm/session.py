"""Session services the operators share: checkpoints, scratch folders, worker imports."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def workers_import_this(spark: SparkSession) -> None:
    """Let Python workers started from a checkout import this package.

    On a cluster the package is installed or sent with --py-files; this only
    adds the checkout to the workers' PYTHONPATH. Texts are long: unless the
    session has set other sizes, batches to the workers are made smaller.
    """
    for key, usual, less in (("maxRecordsPerBatch", "10000", "1000"), ("maxBytesPerBatch", "67108864b", "8388608b")):
        if spark.conf.get(f"spark.sql.execution.arrow.{key}", usual) == usual:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", less)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, else a
    temporary one, which only a local session (tests) can use."""
    set_to = spark.conf.get("spark.checkpoint.dir", None)
    if set_to:
        return set_to.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    key = "deliverylens.shared.dir"
    found = spark.conf.get(key, None)
    if not found:
        found = "file://" + tempfile.mkdtemp(prefix="deliverylens-")
        spark.conf.set(key, found)
    return found


def checkpoint(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder, which also cuts lineage."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def drop_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner delete shuffle files that no live DataFrame needs."""
    for _ in range(2):  # objects freed by the first round hold the shuffles that the second finds
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)
