"""Folders for what a query writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share; a local session has a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{(base or 'file://' + tempfile.mkdtemp(prefix='stream-')).rstrip('/')}/{name}-{uuid.uuid4().hex}"
