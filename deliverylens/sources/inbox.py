"""Bundles that arrive in an inbox or a store: imported once, and indexed a bounded number at a time."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deliverylens.functions import columns as C
from deliverylens.operators.dedup import keep_first
from deliverylens.operators.ingest import extra_attributes
from deliverylens.operators.versions import Appended, VersionedTable

from .events import ACTOR, bundle_files, event_time, flat, parsed

LEDGER = "digest string, file string, machine_id string, window_start string, window_end string, events long, rejected long, measured boolean, fault string"
INDEX = "key string, person string, covered_from date, covered_to date, day date, event_type string, n long"
#: What a machine can read.
SURFACES = ("repos", "copilot", "vscode", "rtk", "agent")


def measured() -> Column:
    """Whether a bundle's machine could measure anything: it has events, is older than the question, or names a surface."""
    watching = F.coalesce(*[F.when(F.col("m.sources")[s], True) for s in SURFACES], F.lit(False))
    return F.coalesce(F.col("m.event_count") > 0, F.lit(False)) | F.col("m.sources").isNull() | watching


def put_bundles(bundles: DataFrame, path: str, folders: int = 64) -> int:
    """Write bundles (name, value) into an inbox on any store that Arrow can open, a file each; how many there are.

    A file appears whole under its name, so a task that runs twice only replaces it. Files lie
    in folders by a hash of their names, which Spark lists side by side.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        uri = "file://" + path.removeprefix("file:") if path.startswith("file:") and not path.startswith("file://") else path
        store, at = fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)
        made = set()
        for batch in batches:
            for name, value, k in zip(*(c.to_pylist() for c in batch.columns)):
                if k not in made:
                    store.create_dir(f"{at}/{k:03d}", recursive=True)
                    made.add(k)
                aside = f"{at}/{k:03d}/{name}.{uuid.uuid4().hex}.tmp"
                with store.open_output_stream(aside) as out:
                    out.write(value.encode())
                store.move(aside, f"{at}/{k:03d}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    rows = bundles.select("name", "value", F.pmod(F.xxhash64("name"), F.lit(folders)).alias("k"))
    return rows.mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0


def import_inbox(path: str, table: Appended, ledger: VersionedTable, allowed: dict[str, list[str]], identities: DataFrame, names: str = "*.ndjson") -> DataFrame:
    """One pass over an inbox: new bundles' events go to the table, the bundles to the ledger, whose new rows it returns.

    A bundle is known by the digest of its whole text, under whatever name; one with a
    fault is recorded with it and brings nothing. Events whose attributes go beyond
    ``allowed`` for their type are rejected one by one. Of events with one id the first
    stays, and those that the table has are left out. ``identities`` (file, person_id)
    fills missing people and never replaces one; a file is its last path part. Events come
    before the ledger, so a pass that stops between them is made good by the next. Files are
    read once: new bundles are kept aside, for the table and the ledger, until the pass ends.
    """
    spark = ledger.spark
    seen = ledger.version()
    known = ledger.read(seen).select("digest")
    files = bundle_files(spark, path, names).withColumn("file", F.element_at(F.split("file", "/"), -1))
    nth = F.row_number().over(Window.partitionBy("digest").orderBy("file"))
    files = files.join(known, "digest", "left_anti").withColumn("nth", nth).where("nth = 1").drop("nth")
    aside = f"_read-{uuid.uuid4().hex}"
    try:
        files.write.parquet(f"{table.folder.path}/{aside}")
        files = spark.read.schema(files.schema).parquet(f"{table.folder.path}/{aside}")
        lines = files.where("fault IS NULL").select("file", "digest", F.explode("rows").alias("value"))
        rows = flat(parsed(lines).where("e.event_type IS NOT NULL"), "file", "digest").withColumn("bad", F.size(extra_attributes(allowed)) > 0)
        who = identities.where("trim(person_id) != ''").select("file", F.col("person_id").alias("who"))
        good = rows.where("NOT bad").join(who, "file", "left").withColumn("person_id", F.coalesce("person_id", "who")).drop("bad", "who", "file", "digest")
        table.append(keep_first(good).join(table.read().select("event_id"), "event_id", "left_anti"))
        counts = rows.groupBy("digest").agg(F.count_if(~F.col("bad")).alias("good"), F.count_if("bad").alias("rejected"))
        told = files.join(counts, "digest", "left").select(
            "digest", "file", "m.machine_id", "m.window_start", "m.window_end", F.coalesce("good", F.lit(0)).cast("long").alias("events"), F.coalesce("rejected", F.lit(0)).cast("long").alias("rejected"),
            F.when(F.col("fault").isNull(), measured()).alias("measured"), "fault",
        )
        after = ledger.replace(ledger.read(seen).unionByName(told), seen)
    finally:
        table.folder.delete(aside)
    return ledger.read(after).join(ledger.read(seen).select("digest"), "digest", "left_anti")


def refresh_index(objects: DataFrame, index: Appended, budget: int = 96, offset: str = "+07:00") -> int:
    """Read up to ``budget`` stored bundles that the index doesn't have, the latest first; how many remain.

    objects: (key, person, uploaded_at, value) of stored bundles, value their whole text. The index has,
    for each key, its events by local day and type, and the days of its window; a key with no
    readable events has one row without a day, so that it isn't read again. Bundles never
    change, and a refresh is published whole: refreshes that stop at any point, or run
    twice, give the index of one that reads all. A window is a span of dates, so its times' zone plays no part.
    """
    known = index.read().select("key").distinct()
    pending = objects.select("key", "uploaded_at").dropDuplicates(["key"]).join(known, "key", "left_anti")
    total = pending.count()
    mine = objects.join(pending.orderBy(F.desc("uploaded_at"), "key").limit(budget).select("key"), "key", "left_semi").dropDuplicates(["key"])
    p = F.split("value", "\n", 2)
    head = F.from_json(p[0], "_manifest struct<window_start string, window_end string>")["_manifest"]
    rows = F.filter(F.split(F.coalesce(F.get(p, F.lit(1)), F.lit("")), "\n"), lambda x: F.trim(x) != "")
    date = lambda c: F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd")
    files = mine.select("key", "person", date(head["window_start"]).alias("covered_from"), date(head["window_end"]).alias("covered_to"), F.explode_outer(rows).alias("value"))
    e = F.from_json("value", "event_type string, event_time string")
    read = files.select("key", "person", "covered_from", "covered_to", C.local_day(event_time(e["event_time"]), offset).alias("day"), e["event_type"].alias("event_type"))
    read = read.withColumn("event_type", F.when(F.col("day").isNotNull(), F.coalesce("event_type", F.lit("unknown"))))
    index.append(read.groupBy("key", "person", "covered_from", "covered_to", "day", "event_type").agg(F.count("day").alias("n")))
    return max(0, total - budget)


def indexed_days(index: Appended) -> DataFrame:
    """(person, day, event_type, n) of an index; a bundle that two refreshes read at once counts once."""
    return index.read().where("day IS NOT NULL").dropDuplicates(["key", "day", "event_type"]).groupBy("person", "day", "event_type").agg(F.sum("n").alias("n"))
