"""Keep-first deduplication and latest-state folds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: str = "event_id", at=("ingested_at", "event_time")) -> DataFrame:
    """Of the rows with one key the earliest arrival stays; ties fall to the row's own hash."""
    order = [F.coalesce(*at).asc_nulls_last(), F.xxhash64(*[c for c in df.columns])]
    return df.withColumn("_nth", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_nth = 1").drop("_nth")


def latest(df: DataFrame, keys: list[str], at: str, tie: str) -> DataFrame:
    """The last known row of each key: stock, not flow."""
    w = Window.partitionBy(*keys).orderBy(F.col(at).desc_nulls_last(), F.col(tie).desc())
    return df.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")
