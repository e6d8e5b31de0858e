"""Line dedup by overlapping three-line windows, with DataFrame functions only.

Every run of three consecutive lines is hashed; of equal windows the one that
starts first (smallest doc_id, then line) stays, and the lines of all later
ones are removed, overlapping windows merged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .session import checkpoint

WINDOW = 3


def windows(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """(doc_id, pos, h1, h2) for each window that holds a word; pos counts lines from 0.

    Two 64-bit hashes stand for the lines' exact texts. Windows of blank lines
    only are no evidence of copying and are left out.
    """
    lines = docs.select("doc_id", F.split("text", "\n", -1).alias("l")).where(F.size("l") >= size)
    each = lines.select("doc_id", F.posexplode(F.expr(f"transform(sequence(0, size(l) - {size}), i -> slice(l, i + 1, {size}))")).alias("pos", "w"))
    filled = F.concat_ws("\n", "w").rlike(r"[^\x20\x09-\x0D]")
    return each.where(filled).select("doc_id", "pos", F.xxhash64("w").alias("h1"), F.xxhash64(F.lit(size), "w").alias("h2"))


def later_windows(found: DataFrame) -> DataFrame:
    """The windows (doc_id, pos) that an equal one precedes.

    The hashes are counted with map-side sums, so a window that a third of all
    documents share is one row a task. The repeated hashes are checkpointed
    before the join back: Spark splits a hot key only where both sides of a join
    are shuffles of their own.
    """
    first = found.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "pos")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = found.join(checkpoint(first), ["h1", "h2"])
    return again.where(~F.struct("doc_id", "pos").eqNullSafe(F.col("first"))).select("doc_id", "pos")


def removed_lines(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """(doc_id, gone): the sorted line numbers to remove, for documents that lose any."""
    later = later_windows(windows(docs, size))
    runs = later.groupBy("doc_id").agg(F.sort_array(F.collect_set("pos")).alias("starts"))
    covered = F.expr(f"array_sort(array_distinct(flatten(transform(starts, p -> sequence(p, p + {size - 1})))))")
    return runs.select("doc_id", covered.alias("gone"))


def dedup_lines(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` with ``text`` cut, and n_lines and n_removed_lines added.

    A document is its doc_id and its text: rows that share an id but differ in
    text are documents of their own, ordered by a hash of the text; rows equal
    in both are one document, cut alike. Rows with a null id are kept as they
    are. A null text has no lines and stays null; texts of fewer than three lines stay whole; an empty table gives an
    empty result. Other columns are kept; n_lines and n_removed_lines in the
    input are replaced.
    """
    docs = docs.drop("n_lines", "n_removed_lines")
    key = F.struct("doc_id", F.xxhash64("text").alias("t"))
    mine = docs.where("doc_id IS NOT NULL").select(key.alias("doc_id"), "text")
    gone = removed_lines(mine, size).withColumnsRenamed({"doc_id": "__id", "gone": "__gone"})
    out = docs.join(gone, key == gone["__id"], "left")
    # The one-element array binds the split lines to a name, so that they are split once.
    kept = F.expr(r"transform(array(split(text, '\n', -1)), l -> array_join(transform(array_except(sequence(0, size(l) - 1), __gone), i -> l[i]), '\n'))[0]")
    return out.select(
        *[F.when(F.col("__gone").isNull(), F.col("text")).otherwise(kept).alias("text") if c == "text" else docs[c] for c in docs.columns],
        F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1))).cast("long").alias("n_lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_removed_lines"),
    )


#: The same in DuckDB, over documents: what op2 returns.
ORACLE_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
  FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL
), three AS (
  SELECT doc_id, pos, line, lead(line, 1) OVER w AS b, lead(line, 2) OVER w AS c FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), wins AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY line, b, c ORDER BY doc_id, pos) AS nth
  FROM three WHERE c IS NOT NULL AND regexp_matches(line || b || c, '[^\x20\x09-\x0D]')
), gone AS (
  SELECT DISTINCT doc_id, pos + k AS pos FROM wins, (VALUES (0), (1), (2)) AS o(k) WHERE nth > 1
), kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL) AS text,
         count(*) AS n_lines, count(g.pos) AS n_removed_lines
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos GROUP BY l.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed_lines, 0) AS n_removed_lines
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
