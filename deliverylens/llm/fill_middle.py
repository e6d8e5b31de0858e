"""Fill-in-the-middle documents: cut each text in two places and move its middle to the end.

A batch of texts is worked on as the two Arrow buffers it comes in, with no loop
over rows: a table of byte classes and one comparison of each byte with the byte
before it mark where units begin, a running count of these marks, less its value at
the start of a document, numbers the units, and one ``searchsorted`` turns the cuts
of all rows into places of bytes. What the draws are is settled before, in the
JVM, by a hash of the key: a row has the same cuts on any run and any partitioning.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .session import workers_import_this

SENTINELS = ("<P>", "<S>", "<M>")
CONTINUES, SPACE, FEED, LEAD = range(4)
_CLASS = np.full(256, LEAD, dtype=np.uint8)
_CLASS[0x80:0xC0] = CONTINUES
_CLASS[[0x20, 9, 11, 12, 13]] = SPACE
_CLASS[10] = FEED
#: STARTS[unit][class before, class]: whether a unit begins between two bytes.
STARTS = {name: np.zeros((4, 4), dtype=bool) for name in ("char", "word", "line")}
STARTS["char"][:, [SPACE, FEED, LEAD]] = True
STARTS["word"][[SPACE, FEED], LEAD] = True  # white space belongs to the word before it
STARTS["line"][FEED, :] = True  # a line has its line feed


def check_sentinels(sentinels: tuple[str, str, str]) -> None:
    """No sentinel may be empty, lie in another, or end as one begins: then an output is read back in one way only."""
    for a in range(3):
        for b in range(3):
            x, y = sentinels[a], sentinels[b]
            if not x or (a != b and x in y) or any(x.endswith(y[:k]) for k in range(1, len(y) + (a != b))):
                raise ValueError("sentinels must be distinct strings that cannot overlap")


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array without nulls, and its offsets into them (from 0)."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def _strings(offsets: np.ndarray, raw: np.ndarray) -> pa.Array:
    """Strings over a shared buffer, not copied."""
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw))


def _join(*parts: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise(*parts, "")


def units(raw: np.ndarray, offsets: np.ndarray, unit: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(running count of unit starts, its value before each document, units of each document)."""
    kind = _CLASS[raw]
    mark = np.zeros(len(raw), dtype=bool)
    if len(raw):
        mark[1:] = STARTS[unit][kind[:-1], kind[1:]]
        mark[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    count = np.cumsum(mark, dtype=np.int32 if len(raw) < 2**31 else np.int64)
    edge = np.concatenate(([0], count))[offsets] if len(raw) else np.zeros(len(offsets), dtype=np.int64)
    return count, edge[:-1].astype(np.int64), np.diff(edge).astype(np.int64)


def cut(texts: pa.Array, draws: np.ndarray, unit: str, fim_percent: int, spm_percent: int, sentinels: tuple[str, str, str]) -> pa.RecordBatch:
    """The outputs of a batch; draws has four unsigned 32-bit numbers a row."""
    raw, offsets = _buffers(texts)
    count, before, n = units(raw, offsets, unit)
    a, b = draws[:, 0] % (n + 1), draws[:, 1] % (n + 1)
    cuts = np.stack((np.minimum(a, b), np.maximum(a, b)), axis=1)
    place = np.searchsorted(count, before[:, None] + cuts + 1)
    place = np.where(cuts == n[:, None], offsets[1:, None], place)  # after the last unit
    held = np.zeros(len(texts), dtype=bool)
    for s in sentinels:
        held |= np.asarray(pc.match_substring(texts, s))
    plain = (n == 0) | held | (draws[:, 2] % 100 >= fim_percent)
    spm = ~plain & (draws[:, 3] % 100 < spm_percent)
    parts = _strings(np.append(np.column_stack((offsets[:-1], place)).ravel(), offsets[-1]), raw)
    prefix, middle, suffix = (parts.take(pa.array(np.arange(k, 3 * len(texts), 3))) for k in range(3))
    p, s, m = (pa.scalar(x) for x in sentinels)
    out = pc.if_else(pa.array(spm), _join(s, suffix, p, prefix, m, middle), _join(p, prefix, s, suffix, m, middle))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(n),
            pa.array(np.where(plain, "plain", np.where(spm, "spm", "psm")).astype(object), pa.string()),
            pa.array(cuts[:, 0], mask=plain),
            pa.array(cuts[:, 1] - cuts[:, 0], mask=plain),
            pc.if_else(pa.array(plain), texts, out),
        ],
        names=["n", "form", "prefix_units", "middle_units", "output"],
    )


def uncut(outputs: pa.Array, forms: pa.Array, sentinels: tuple[str, str, str]) -> pa.Array:
    """The texts that a batch of outputs was made of, read from outputs and forms alone."""
    raw, offsets = _buffers(outputs)
    plain, spm = np.asarray(pc.equal(forms, "plain")), np.asarray(pc.equal(forms, "spm"))
    p, s, m = sentinels
    size = [len(x.encode()) for x in sentinels]
    second = np.where(spm, np.asarray(pc.find_substring(outputs, p)), np.asarray(pc.find_substring(outputs, s)))
    third = np.asarray(pc.find_substring(outputs, m))
    if np.any(~plain & ((second < 0) | (third < second))):
        raise ValueError("an output lacks a sentinel of its form")
    zero = np.zeros(len(outputs), dtype=np.int64)
    ends = np.column_stack((
        zero, np.where(spm, size[1], size[0]), second, second + np.where(spm, size[0], size[1]), third, third + size[2],
    ))
    ends[plain] = 0  # all of a plain output is its last part
    parts = _strings(np.append((offsets[:-1, None] + ends).ravel(), offsets[-1]), raw)
    one, two, last = (parts.take(pa.array(np.arange(k, 6 * len(outputs), 6))) for k in (1, 3, 5))
    return pc.if_else(pa.array(spm), _join(two, last, one), _join(one, last, two))


def draws(key: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers of a row: the first groups of the SHA-256 of ``seed:key`` (null key: nothing)."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(h, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def fill_in_middle(
    docs: DataFrame, key: str = "doc_id", text: str = "text", unit: str = "char", seed: int = 1,
    fim_percent: int = 90, spm_percent: int = 20, sentinels: tuple[str, str, str] = SENTINELS,
) -> DataFrame:
    """(key, n, form, prefix_units, middle_units, output) of each row, no shuffle.

    ``unit`` is char (code points), word (with the white space behind it) or line
    (with its line feed); n counts them. Form psm is prefix, suffix, middle; spm
    suffix, prefix, middle; plain the text itself, with null counts. A null text is
    empty; empty texts and such as hold a sentinel stay plain. Rows of one key have
    the same draws; a null key draws as an empty one. Other columns are neither
    read nor returned, whatever their names.
    """
    check_sentinels(sentinels)
    if unit not in STARTS:
        raise ValueError(f"unit must be one of {', '.join(STARTS)}")
    workers_import_this(docs.sparkSession)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                numbers = np.column_stack([np.asarray(batch.column(k)) for k in range(2, 6)])
                made = cut(batch.column(1), numbers, unit, fim_percent, spm_percent, sentinels)
                yield pa.RecordBatch.from_arrays([batch.column(0), *made.columns], names=["key", *made.schema.names])

    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"), *draws(F.col(key), seed))
    fields = [T.StructField("key", rows.schema["key"].dataType)]
    fields += [T.StructField(n, T.StringType() if n in ("form", "output") else T.LongType()) for n in ("n", "form", "prefix_units", "middle_units", "output")]
    return rows.mapInArrow(run, T.StructType(fields)).withColumnRenamed("key", key)


def restore(made: DataFrame, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """``made`` with ``restored``, the text that each output was made of, from output and form alone.

    An output without its form's sentinels is an error; a column ``restored`` is replaced.
    """
    check_sentinels(sentinels)
    workers_import_this(made.sparkSession)
    rows = made.drop("restored")
    at = [rows.columns.index(c) for c in ("output", "form")]

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                back = uncut(batch.column(at[0]), batch.column(at[1]), sentinels)
                yield pa.RecordBatch.from_arrays([*batch.columns, back], names=[*batch.schema.names, "restored"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("restored", T.StringType())]))


def op13(docs: DataFrame) -> DataFrame:
    """The digest columns of the query, from the outputs and the restored texts."""
    out = restore(fill_in_middle(docs))
    sha = [F.sha2(F.encode(F.col(c), "UTF-8"), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return out.select("doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"), *sha)


#: The same rows without any cutting of bytes: string functions over code points.
ORACLE_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), r AS (
  SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM d
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM r
), p AS (
  SELECT *, substring(t, 1, a) AS pre, substring(t, a + 1, b - a) AS mid, substring(t, b + 1) AS suf FROM c
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
