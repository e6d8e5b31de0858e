"""Table maintenance as functions of DataFrames: upserts, rebuilt windows, price changes, expiry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the source replace those of the target with the same key; others are added."""
    return target.join(source.select(*keys), keys, "left_anti").unionByName(source)


def upsert_on_change(target: DataFrame, source: DataFrame, keys: list[str], state: str, moved: str) -> DataFrame:
    """As ``upsert``, but ``moved`` is taken from the source only where ``state`` changed."""
    old = target.select(*keys, F.col(state).alias("_s"), F.col(moved).alias("_m"), F.lit(True).alias("_old"))
    new = source.join(old, keys, "left")
    keep = F.col("_old").isNotNull() & F.col(state).eqNullSafe(F.col("_s"))
    new = new.withColumn(moved, F.when(keep, F.col("_m")).otherwise(F.col(moved))).drop("_s", "_m", "_old")
    return upsert(target, new.select(*source.columns), keys)


def write_window(df: DataFrame, path: str, day: str = "day", since: str | None = None) -> None:
    """Replace the days that ``df`` has and leave the others. With ``since``, the
    window from that day on is rebuilt: its days that ``df`` doesn't have go too."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)
    if since is None:
        return
    spark = df.sparkSession
    have = {str(r[0]) for r in df.where(F.col(day) >= F.lit(since)).select(day).distinct().collect()}  # a row a day
    old = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = old.getFileSystem(spark._jsc.hadoopConfiguration())
    for entry in store.listStatus(old):
        name, _, value = entry.getPath().getName().partition("=")
        if name == day and value >= since and value not in have:
            store.delete(entry.getPath(), True)


def replace_all(df: DataFrame, path: str) -> None:
    """A table that is written whole each time, such as one of one row."""
    df.coalesce(1).write.mode("overwrite").parquet(path)


def write_once(objects: DataFrame, known: DataFrame, digest: str = "sha256") -> DataFrame:
    """The objects whose digest isn't stored yet, with the key they are stored under."""
    key = F.concat(F.lit("bundles/"), "iso_week", F.lit("/"), "person_id", F.lit("/"), F.substring("machine_id", 1, 8), F.lit("-"), digest, F.lit(".ndjson"))
    return objects.dropDuplicates([digest]).join(known.select(digest), digest, "left_anti").withColumn("key", key)


def append_new(target: DataFrame, source: DataFrame, key: str = "event_id") -> DataFrame:
    """The rows of the source whose key the target doesn't have, once each."""
    return source.dropDuplicates([key]).join(target.select(key), key, "left_anti").select(*source.columns)


def set_price(book: DataFrame, model_id: str, start: str, rates: dict[str, float | None]) -> DataFrame:
    """The price book after a change: the open row ends the day before, a new one opens.

    A change that doesn't start after the open row's start is refused by
    leaving the book as it is.
    """
    day = F.to_date(F.lit(start))
    mine = (F.col("model_id") == model_id) & F.col("effective_to").isNull()
    ok = book.where(mine).agg(F.coalesce(F.max("effective_from") < day, F.lit(True)).alias("ok"))
    closed = book.crossJoin(F.broadcast(ok)).withColumn("effective_to", F.when(mine & F.col("ok"), F.date_sub(day, 1)).otherwise(F.col("effective_to"))).drop("ok")
    new = ok.where("ok").select(*[
        (F.lit(model_id) if c == "model_id" else day if c == "effective_from" else F.lit(None) if c == "effective_to" else F.lit(rates.get(c))).cast(t).alias(c) for c, t in book.dtypes
    ])
    return closed.unionByName(new)


def expire(df: DataFrame, day: str, as_of: str, days: int) -> DataFrame:
    """Without the partitions older than so many days."""
    return df.where(F.col(day) >= F.date_sub(F.to_date(F.lit(as_of)), days))


def pack_bundles(events: DataFrame, machine: str, most: int = 10_000) -> DataFrame:
    """Bundles of an ISO week: (iso_week, part, machine_id, event_count, sha256, body).

    A week of more than about ``most`` events is dealt into parts by a hash of
    the event's id, so that no row grows with the data. Events are in order of
    time and id inside a bundle.
    """
    week = F.concat(F.extract(F.lit("YEAROFWEEK"), F.col("event_time")), F.lit("-W"), F.lpad(F.weekofyear("event_time").cast("string"), 2, "0"))
    line = F.to_json(F.struct(*sorted(events.columns)))
    rows = events.select(week.alias("iso_week"), "event_id", F.struct("event_time", "event_id", line.alias("line")).alias("r"))
    parts = rows.groupBy("iso_week").agg(F.ceil(F.count("*") / most).alias("parts"))
    rows = rows.join(parts, "iso_week").withColumn("part", F.pmod(F.xxhash64("event_id"), F.col("parts")))
    out = rows.groupBy("iso_week", "part").agg(F.count("*").alias("event_count"), F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["line"]), "\n").alias("body"))
    return out.select("iso_week", "part", F.lit(machine).alias("machine_id"), "event_count", F.sha2("body", 256).alias("sha256"), "body")
