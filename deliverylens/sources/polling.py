"""Polls of changing sources behind a high-water mark."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deliverylens.operators.versions import Appended, VersionedTable

MARKS = "source string, mark timestamp, runs long"


class Pass(NamedTuple):
    """What a pass did: rows read and the mark after it."""

    read: int
    mark: object
    moved: bool


def mark_of(marks: DataFrame, source: str):
    row = marks.where(F.col("source") == source).select("mark").first()
    return row[0] if row else None


def poll(read: Callable[[object], DataFrame], source: str, table: Appended, marks: VersionedTable, *, key: str = "event_id", at: str = "updated_at", complete: bool = True) -> Pass:
    """One pass over a source: ``read(mark)`` gives its rows that changed at or after the mark.

    Rows whose key the table doesn't have are published together, once all are
    written; then the mark goes to the latest time read, never back and never to null.
    A pass that fails publishes nothing and leaves the mark. A pass that is known to be
    partial (``complete=False``) publishes its rows but leaves the mark, so the
    next one reads the same window again; keys make that safe. A crash between the two
    steps has the same effect.
    """
    seen = marks.version()
    state = marks.read(seen)
    since = mark_of(state, source)
    aside = f"_read-{uuid.uuid4().hex}"  # the source is read once: what is published and what the mark says come from one read
    try:
        read(since).write.parquet(f"{table.folder.path}/{aside}")
        rows = state.sparkSession.read.parquet(f"{table.folder.path}/{aside}")
        n, mark = rows.agg(F.count("*"), F.max(at)).first()
        table.append(rows.dropDuplicates([key]).join(table.read().select(key), key, "left_anti"))
    finally:
        table.folder.delete(aside)
    if not complete or mark is None or (since is not None and mark <= since):
        return Pass(n, since, False)
    mine = F.col("source") == source
    moved = state.where(~mine).unionByName(
        state.sparkSession.range(1).select(F.lit(source).alias("source"), F.lit(mark).alias("mark"), F.lit((state.where(mine).select("runs").first() or [0])[0] + 1).cast("long").alias("runs"))
    )
    marks.replace(moved, seen)
    return Pass(n, mark, True)
