"""Substring dedup by relative Lempel-Ziv parsing against the whole corpus.

The corpus is its own reference. Every document is cut at content-defined
anchors: the minimiser (a 5-word hash) of each 20-word window. The windows that
share an anchor form a reference block; blocks are indexed by the anchor's and
the block's hash, with the first place of each. A document is then parsed from
left to right into factors: a block seen earlier extends the factor that ends
there in the same source, or opens a new one. Blocks whose anchor is known but
whose words are not lie at factor boundaries; their windows are looked up one
by one. Any window of a factor is a copy of earlier text, so every factor is at
least 20 words long and its words are duplicate.

What is shuffled is one small row an anchor (about one in eight words), not a
row a window. Hot anchors are pre-aggregated, and what is joined back to them is
one row a key, checkpointed so that Spark can split the other side of the join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .session import checkpoint, drop_shuffles, workers_import_this

WINDOW, GRAM = 20, 5


def _words(text: str | bytes | None) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    raw, starts, ends = _spans(text if isinstance(text, bytes) else (text or "").encode())
    return raw, starts, ends, W.word_hashes(np.frombuffer(raw, dtype=np.uint8), starts, ends)


def _spans(raw: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    return raw, *W.spans(np.frombuffer(raw, dtype=np.uint8))


def _leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """Where the leftmost least value of each run of ``width`` values lies; runs
    of twice the length are made of two until they are long enough."""
    least, place, k = values, np.arange(len(values)), 1
    while k < width:
        step = min(k, width - k)
        right = least[step:] < least[:-step]
        place = np.where(right, place[step:], place[:-step])
        least = np.where(right, least[step:], least[:-step])
        k += step
    return place


def blocks(hashes: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, content, start, n) of each reference block of a document.

    Window starts [start, start + n) have the same leftmost minimiser; content
    is the hash of all words those windows cover.
    """
    n = len(hashes) - window + 1
    if n <= 0:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    grams = W.window_hashes(hashes, gram)
    place = _leftmost_least(grams, window - gram + 1)
    start = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    size = np.diff(np.append(start, n))
    return grams[place[start]], W.range_hashes(hashes, start, start + size + window - 1), start, size


def block_rows(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(h, r, id, s, n) for the blocks of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, rows = [], 0
            for k in range(batch.num_rows):
                h, r, s, n = blocks(_words(batch.column(1)[k].as_py())[3], window, gram)
                if len(h):
                    out.append((h, r, np.full(len(h), k), s, n))
                    rows += len(h)
                if rows > 100_000 or (rows and k + 1 == batch.num_rows):
                    h, r, i, s, n = map(np.concatenate, zip(*out))
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(r.view(np.int64)), batch.column(0).take(pa.array(i)), pa.array(s.astype(np.int32)), pa.array(n.astype(np.int16))], names=["h", "r", "id", "s", "n"])
                    out, rows = [], 0

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"h long, r long, id {kind}, s int, n short")


def known_blocks(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """The blocks whose anchor occurs twice or more: (h, r, id, s, n, mixed).

    mixed: the anchor's blocks differ in their words.
    """
    rows = block_rows(docs, window, gram)
    anchors = checkpoint(rows.groupBy("h").agg(F.count("*").alias("c"), (F.min("r") != F.max("r")).alias("mixed")).where("c > 1").drop("c"))
    drop_shuffles(docs.sparkSession)
    return checkpoint(rows.join(anchors, "h"))


def packed(docs: DataFrame) -> DataFrame:
    """(id, z): the texts compressed, as which they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            z = [tool.compress((t.as_py() or "").encode()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(z, pa.binary())], names=["id", "z"])

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, z binary")


def _held_by(hashes: np.ndarray, s: np.ndarray, words: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Which spans (start, words) of a text have the hash r; a text of another row with the same id may be shorter or differ."""
    ok = s + words <= len(hashes)
    out = np.zeros(len(s), dtype=bool)
    out[ok] = W.range_hashes(hashes, s[ok], s[ok] + words[ok]) == r[ok]
    return out


def window_rows(marks: DataFrame, docs: DataFrame, window: int) -> DataFrame:
    """(w1, w2, id, s) for each window of the marked blocks (id, s, n, r) that a row has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdDecompressor()
        for batch in batches:
            for k in range(batch.num_rows):
                hashes = _words(tool.decompress(batch.column(2)[k].as_py()))[3]
                part = batch.column(1)[k].values
                s, n = part.field("s").to_numpy().astype(np.int64), part.field("n").to_numpy().astype(np.int64)
                mine = _held_by(hashes, s, n + (window - 1), part.field("r").to_numpy().view(np.uint64))
                s, n = s[mine], n[mine]
                each = np.repeat(s - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
                one = W.range_hashes(hashes, each, each + window)
                two = W.window_hashes(hashes, window)[each]
                yield pa.RecordBatch.from_arrays([pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), batch.column(0).take(pa.array(np.full(len(each), k))), pa.array(each.astype(np.int32))], names=["w1", "w2", "id", "s"])

    kind = docs.schema["id"].dataType.simpleString()
    lists = marks.groupBy("id").agg(F.collect_list(F.struct("s", F.col("n").cast("int").alias("n"), "r")).alias("m"))
    return lists.join(packed(docs), "id").select("id", "m", "z").mapInArrow(run, f"w1 long, w2 long, id {kind}, s int")


def matches(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(id, s, n, ref, ref_s, r): runs of n window starts from word s whose windows
    start earlier at ref_s of document ref; r is the hash of all their words. docs has columns id and text."""
    found = known_blocks(docs, window, gram)
    drop_shuffles(docs.sparkSession)
    place = F.struct("id", "s")
    first = found.groupBy("h", "r").agg(F.min(F.struct("id", "s", "n")).alias("f"), F.first("mixed").alias("mixed"), F.count("*").alias("c"))
    first = checkpoint(first.where("c > 1 OR mixed"))
    again = found.join(first.where("c > 1").select("h", "r", F.struct("f.id", "f.s").alias("f")), ["h", "r"]).where(place != F.col("f"))
    whole = again.select("id", "s", F.col("n").cast("int").alias("n"), F.col("f.id").alias("ref"), F.col("f.s").alias("ref_s"), "r")
    edge = checkpoint(window_rows(first.where("mixed").select("f.*", "r"), docs, window))
    drop_shuffles(docs.sparkSession)
    one = checkpoint(edge.groupBy("w1", "w2").agg(F.min(place).alias("f"), F.count("*").alias("c")).where("c > 1").drop("c"))
    single = edge.join(one, ["w1", "w2"]).where(place != F.col("f")).select("id", "s", F.lit(1).alias("n"), F.col("f.id").alias("ref"), F.col("f.s").alias("ref_s"), F.col("w1").alias("r"))
    return whole.union(single)


def parse(runs: list[tuple], window: int = WINDOW) -> list[tuple]:
    """Greedy factors (start, length, ref, ref_start) from matched runs (s, n, ref, ref_s).

    From left to right, the run that continues the open factor's source extends
    it; any other closes it and opens the next. Lengths count words.
    """
    out: list[list] = []
    for s, n, ref, ref_s in sorted(runs, key=lambda x: (x[0], -x[1])):
        last = out[-1] if out else None
        if last and s <= last[0] + last[1] and ref == last[2] and ref_s - s == last[3] - last[0]:
            last[1] = max(last[1], s + n - last[0])
        else:
            out.append([s, n, ref, ref_s])
    return [(s, n + window - 1, ref, ref_s) for s, n, ref, ref_s in out]


def factors(docs: DataFrame, *, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, factors, kept) for every document.

    ``factors``: the copied spans, in words, with their earlier source; spans
    may overlap. n_removed counts the words they cover, ``kept`` is the others
    joined by one space. Rows with a null id are parsed as if nothing stood
    elsewhere (no factors). Rows that share an id are cut each by its own text: a
    span found in one is looked for in the other by its hash, and equal windows at
    equal places of them count as one place. A null or short text has no factors;
    an empty table gives an empty result.
    """
    spark = docs.sparkSession
    workers_import_this(spark)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    found = matches(docs.where("id IS NOT NULL"), window, gram)
    # Only the rows of ids that come again need the hashes of their spans.
    again = docs.where("id IS NOT NULL").groupBy(F.col("id").alias("again")).agg(F.count("*").alias("c")).where("c > 1").select("again")
    found = found.join(again, found["id"] == again["again"], "left").withColumn("r", F.when(F.col("again").isNotNull(), F.col("r")))
    # Written before the texts are joined, so that no shuffle of the search is kept beside theirs.
    lists = checkpoint(found.groupBy("id").agg(F.collect_list(F.struct("s", "n", "ref", "ref_s", "r")).alias("m")).withColumnRenamed("id", "mid"))
    del found
    drop_shuffles(spark)
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for k in range(batch.num_rows):
                raw, starts, ends = _spans(tool.decompress(batch.column(1)[k].as_py()))
                runs = [tuple(x.values()) for x in batch.column(2)[k].as_py() or ()]
                if runs and runs[0][4] is not None:
                    hashes = W.word_hashes(np.frombuffer(raw, dtype=np.uint8), starts, ends)
                    s, n, r = (np.array([x[c] for x in runs], dtype=np.int64) for c in (0, 1, 4))
                    runs = [x for x, ok in zip(runs, _held_by(hashes, s, n + (window - 1), r.view(np.uint64))) if ok]
                spans = parse([x[:4] for x in runs], window)
                gone = W.covered(len(starts), np.array([x[0] for x in spans]), np.array([x[0] + x[1] for x in spans])) if spans else np.zeros(len(starts), dtype=bool)
                left = np.flatnonzero(~gone)
                if len(left) == len(starts):
                    kept = b" ".join(raw.split())
                else:
                    kept = b" ".join([raw[a:b] for a, b in zip(starts[left].tolist(), ends[left].tolist())])
                rows.append((len(starts), int(gone.sum()), [{"start": a, "length": b, "ref": c, "ref_start": d} for a, b, c, d in spans], kept.decode()))
            cols = list(zip(*rows)) or [[]] * 4
            ref = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("ref", batch.schema.field(0).type), ("ref_start", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], ref), pa.array(cols[3], pa.string())], names=["id", "n_words", "n_removed", "factors", "kept"])

    texts = packed(docs)
    joined = texts.join(lists, texts["id"] == lists["mid"], "left").select("id", "z", "m")
    out = joined.mapInArrow(run, f"id {kind}, n_words long, n_removed long, factors array<struct<start:long,length:long,ref:{kind},ref_start:long>>, kept string")
    return out.withColumnRenamed("id", id_col)


def brute_force(texts: dict[int, str | None], window: int = WINDOW) -> dict[int, tuple[int, int, str]]:
    """(n_words, n_removed, sha256 of the kept text) by a dictionary of all windows."""
    seen: dict[tuple, bool] = {}
    out = {}
    for doc in sorted(texts):
        words = (texts[doc] or "").encode().split()
        gone = set()
        for k in range(len(words) - window + 1):
            key = tuple(words[k : k + window])
            if key in seen:
                gone.update(range(k, k + window))
            seen[key] = True
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out[doc] = (len(words), len(gone), hashlib.sha256(kept).hexdigest())
    return out
