"""Benchmark decontamination: places that hold enough of an item's words, then Smith-Waterman alignment.

Words are runs of ASCII letters, digits and characters beyond ASCII, in lower
case. The share of an item's words that the best local alignment matches is the
score: substituted, inserted and dropped words lower it, they don't hide a copy.

No passage that reaches the score is left out. An alignment that matches m words
spans fewer than 3m words of a document, as its score is positive; of any
n - need + r words of an item it matches r at least. So the rarest words of each
item, that many, are looked up in blocks of a document, and a block that holds r
of them is counted again with all words of the item before it is aligned. Which
words are rare is counted over all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import words as W
from .session import checkpoint, workers_import_this

MIN_SCORE = 0.6
#: The least number of matched words that is evidence of a copy; an item with fewer words has none to give.
MIN_WORDS = 8
#: Words of test items that tasks may hold in memory (about 64 bytes each); with more, blocks are joined.
HELD_GRAMS = 1_000_000
MATCH, MISMATCH, GAP = 2.0, -1.0, -1.0
_OTHER = np.ones(256, dtype=bool)
_OTHER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def tokens(text: str | None) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, word hashes) of the words of a text in lower case."""
    raw = (text or "").lower().encode()
    buf = np.frombuffer(raw, dtype=np.uint8)
    starts, ends = W.spans(buf, _OTHER)
    return raw, starts, ends, W.word_hashes(buf, starts, ends)


def needed(n: int, min_score: float, min_words: int = MIN_WORDS) -> int:
    """The fewest matched words of an item of n that reach the score and the least number."""
    return max(1, min_words, int(np.ceil(min_score * n - 1e-9)))


def item_words(benchmark: DataFrame, min_score: float) -> DataFrame:
    """(item_id, item, i, n, need, cls, words) of the items that have MIN_WORDS words; i
    stands for the text, cls is a class of lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [tokens(t.as_py())[3] for t in batch.column(1)]
            n = [len(h) for h in found]
            cols = [pa.array(n, pa.int32()), pa.array([needed(x, min_score) for x in n], pa.int32()), pa.array([x.bit_length() // 2 for x in n], pa.int32()), pa.array([h.view(np.int64) for h in found], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cols], names=["item_id", "item", "n", "need", "cls", "words"])

    kind = benchmark.schema["item_id"].dataType.simpleString()
    got = benchmark.select("item_id", F.col("text").cast("string").alias("item")).mapInArrow(run, f"item_id {kind}, item string, n int, need int, cls int, words array<long>")
    return checkpoint(got.where("n > 0 AND need <= n").withColumn("i", F.xxhash64("item")))


class Lookup:
    """The places of word hashes in a sorted array of different ones: their first bits lead to the few that begin like them."""

    def __init__(self, known: np.ndarray) -> None:
        bits = max(8, (4 * len(known)).bit_length())
        self.known, self.shift = known, np.uint64(64 - bits)
        ends = np.searchsorted(known >> self.shift, np.arange(2**bits, dtype=np.uint64), side="right")
        self.first = np.concatenate(([0], ends[:-1])).astype(np.int32)
        self.most = int(np.diff(ends, prepend=0).max())

    def places(self, h: np.ndarray) -> np.ndarray:
        """The place of each hash; -1 where it isn't known."""
        at, out = self.first[h >> self.shift], np.full(len(h), -1, dtype=np.int64)
        for k in range(self.most):
            here = np.minimum(at + k, len(self.known) - 1)
            out = np.where(self.known[here] == h, here, out)
        return out


def how_often(docs: DataFrame, items: DataFrame, held: bool) -> DataFrame:
    """(w, c): how many words of all documents are w, for the words of the items; a word that no document has may be left out.

    held: tasks count on an array of the items' words; else all words of a batch are counted.
    """

    def all_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                w, c = np.unique(np.concatenate([tokens(t.as_py())[3] for t in batch.column(0).slice(at, 256)]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(c)], names=["w", "c"])

    each = items.select(F.explode("words").alias("w")).distinct()
    if not held:
        counted = docs.select("text").mapInArrow(all_words, "w long, c long")
        return counted.groupBy("w").agg(F.sum("c").alias("c")).join(each, "w", "left_semi")
    look = Lookup(np.sort(np.array([r.w for r in each.collect()], dtype=np.int64).view(np.uint64)))

    def item_words_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(look.known) + 1, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                seen += np.bincount(look.places(tokens(text.as_py())[3]) + 1, minlength=len(seen))
        some = np.flatnonzero(seen[1:])
        yield pa.RecordBatch.from_arrays([pa.array(look.known[some].view(np.int64)), pa.array(seen[1:][some])], names=["w", "c"])

    return docs.select("text").mapInArrow(item_words_only, "w long, c long").groupBy("w").agg(F.sum("c").alias("c"))


def rarest(docs: DataFrame, items: DataFrame, held: bool = True) -> DataFrame:
    """(i, cls, least, w, times): of each item's text the n - need + least words that
    are rarest in all documents, of which a passage that reaches the score holds ``least``."""
    often = how_often(docs, items, held)
    texts = items.dropDuplicates(["i"]).withColumn("least", F.greatest(F.lit(1), F.expr("need div 2")))
    each = texts.select("i", "cls", "least", (F.col("n") - F.col("need") + F.col("least")).alias("p"), F.explode("words").alias("w"))
    ranked = each.join(often, "w", "left").groupBy("i", "cls", "least", "p").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("c", F.lit(0)).alias("c"), "w"))).alias("x"))
    few = ranked.select("i", "cls", "least", F.explode(F.expr("slice(x, 1, p)")).alias("y"))
    return few.groupBy("i", "cls", "least", F.col("y.w").alias("w")).agg(F.count("*").alias("times"))


def _blocks(place: np.ndarray, word: np.ndarray, step: int, n_doc: int, n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(block, word, times) of a document's words; word is below n_words. A block
    is 2 * step words long and begins at each multiple of step, so that each run
    of up to step words lies in one."""
    at = place // step if n_doc > 2 * step else np.zeros(len(place), dtype=np.int64)
    keep = at > 0
    key, times = np.unique(np.concatenate((at * n_words + word, (at[keep] - 1) * n_words + word[keep])), return_counts=True)
    return key // n_words, key % n_words, times


def _rows(h: np.ndarray, raw: bytes, starts: np.ndarray, ends: np.ndarray, one: np.ndarray, need: int, min_score: float) -> Iterator[tuple]:
    """(score, matched, item words, start, words, passage) of each block whose best alignment with the item reaches the score."""
    words, times = np.unique(one, return_counts=True)
    at = np.minimum(np.searchsorted(words, h), len(words) - 1)
    place = np.flatnonzero(words[at] == h)
    step = 3 * len(one)
    block, word, seen = _blocks(place, at[place], step, len(h), len(words))
    held = np.bincount(block, weights=np.minimum(seen, times[word])) if len(block) else np.zeros(0)
    for k in np.flatnonzero(held >= need).tolist():
        lo, hi = k * step, min(len(h), (k + 2) * step)
        _, matched, a, b = align(one, h[lo:hi])
        if matched >= need and matched / len(one) >= min_score:
            yield matched / len(one), matched, len(one), lo + a, b - a, raw[starts[lo + a] : ends[lo + b - 1]].decode()


_SCORED = ["doc_id", "item_id", "score", "matched", "item_words", "start", "n_words", "passage"]


def _batch(rows: list[tuple], doc_type: pa.DataType, item_type: pa.DataType) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[]] * len(_SCORED)
    kinds = [doc_type, item_type, pa.float64(), *[pa.int64()] * 4, pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=_SCORED)


def _held(docs: DataFrame, items: DataFrame, index: DataFrame, schema: str, min_score: float) -> DataFrame:
    """The scored passages with the words of all items in each task: no text is shuffled."""
    told = [(r.item_id, r.i, r.need, np.array(r.words, dtype=np.int64).view(np.uint64)) for r in items.select("item_id", "i", "need", "words").collect()]
    owners: dict[int, list[int]] = {}
    for k, x in enumerate(told):
        owners.setdefault(x[1], []).append(k)
    number = {i: k for k, i in enumerate(owners)}
    members = list(owners.values())
    by_class: dict[int, list] = {}
    for r in index.collect():
        by_class.setdefault(r.cls, []).append((r.w, number[r.i], r.times, r.least))
    classes = []
    for rows in by_class.values():
        w, item, times, least = (np.array(c, dtype=np.int64) for c in zip(*rows))
        order = np.argsort(w.view(np.uint64), kind="stable")
        mine, local = np.unique(item, return_inverse=True)
        bound = np.zeros(len(mine), dtype=np.int64)
        bound[local] = least
        known, first, count = np.unique(w.view(np.uint64)[order], return_index=True, return_counts=True)
        step = 3 * max(len(told[members[k][0]][3]) for k in mine.tolist())
        classes.append((known, first, count, local[order], times[order], mine, bound, step))
    look = Lookup(np.unique(np.concatenate([x[0] for x in classes])) if classes else np.zeros(0, dtype=np.uint64))
    own = []  # the place in a class of each word of any class
    for known, *_ in classes:
        own.append(np.full(len(look.known), -1, dtype=np.int64))
        own[-1][np.searchsorted(look.known, known)] = np.arange(len(known))
    item_type = to_arrow_type(items.schema["item_id"].dataType)

    def candidates(h: np.ndarray) -> list[int]:
        out: list[np.ndarray] = []
        places = look.places(h)
        met = np.flatnonzero(places >= 0)
        for (known, first, count, item, times, mine, bound, step), local in zip(classes, own):
            at = local[places[met]]
            place = met[at >= 0]
            if len(place) < bound.min():
                continue
            block, word, seen = _blocks(place, at[at >= 0], step, len(h), len(known))
            n = count[word]
            entry = np.repeat(first[word] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            key, back = np.unique(np.repeat(block, n) * len(mine) + item[entry], return_inverse=True)
            held = np.bincount(back, weights=np.minimum(np.repeat(seen, n), times[entry]))
            k = key % len(mine)
            out.append(mine[k[held >= bound[k]]])
        return np.unique(np.concatenate(out)).tolist() if out else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k in range(batch.num_rows):
                raw, starts, ends, h = tokens(batch.column(1)[k].as_py())
                for c in candidates(h) if len(h) else ():
                    _, _, need, one = told[members[c][0]]
                    for row in _rows(h, raw, starts, ends, one, need, min_score):
                        rows += [(batch.column(0)[k].as_py(), told[m][0], *row) for m in members[c]]
            yield _batch(rows, batch.schema.field(0).type, item_type)

    return docs.mapInArrow(run, schema)


def _joined(docs: DataFrame, items: DataFrame, index: DataFrame, schema: str, min_score: float) -> DataFrame:
    """The scored passages by a join of blocks, for test sets too large to hold in every task."""
    steps = [(r.cls, 3 * r.n) for r in items.groupBy("cls").agg(F.max("n").alias("n")).collect()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                h = tokens(batch.column(1)[k].as_py())[3]
                known, word = np.unique(h, return_inverse=True)
                for cls, step in steps if len(h) else ():
                    block, w, seen = _blocks(np.arange(len(h)), word, step, len(h), len(known))
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.full(len(w), k))), pa.array(np.full(len(w), cls, dtype=np.int32)), pa.array(block), pa.array(known[w].view(np.int64)), pa.array(seen)], names=["t", "cls", "block", "w", "seen"])

    docs = docs.withColumn("t", F.xxhash64("text"))
    each = docs.select("t", "text").mapInArrow(cut, "t long, cls int, block long, w long, seen long").distinct()
    held = each.join(index, ["w", "cls"]).groupBy("t", "cls", "block", "i", "least").agg(F.sum(F.least("seen", "times")).alias("n"))
    chosen = checkpoint(held.where("n >= least").select("t", "i").distinct())
    pairs = chosen.join(docs, "t").join(items.select("i", "item_id", "need", "words"), "i").select("doc_id", "item_id", "text", "need", "words")
    item_type = to_arrow_type(items.schema["item_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, item, text, need, one in zip(*(c.to_pylist() for c in batch.columns)):
                raw, starts, ends, h = tokens(text)
                rows += [(doc, item, *row) for row in _rows(h, raw, starts, ends, np.array(one, dtype=np.int64).view(np.uint64), need, min_score)]
            yield _batch(rows, batch.schema.field(0).type, item_type)

    return pairs.mapInArrow(run, schema)


def _next_row(row: np.ndarray, word: np.uint64, passage: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """The row of the alignment table below ``row``."""
    best = np.maximum(row[1:] + GAP, row[:-1] + np.where(passage == word, MATCH, MISMATCH))
    out = np.concatenate(([0.0], np.maximum(best, 0.0)))
    return np.maximum.accumulate(out - steps) + steps  # gaps along the row


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int, int]:
    """Smith-Waterman over word hashes: (score, matched words, first, past the
    last word of the passage) of the best local alignment.

    Of m rows of the table every root of m-th is kept and the rows between are
    made again on the way back: memory is about 2 * root of m rows.
    """
    m, n = len(item), len(passage)
    every = max(1, int(m**0.5))
    steps = GAP * np.arange(n + 1)
    row = np.zeros(n + 1)
    kept, best, i, j = [row], 0.0, 0, 0
    for k in range(1, m + 1):
        row = _next_row(row, item[k - 1], passage, steps)
        if k % every == 0:
            kept.append(row)
        at = int(row.argmax())
        if row[at] > best:
            best, i, j = float(row[at]), k, at
    stop, matched, base, rows = j, 0, -1, []
    while i:
        if base < 0 or i - 1 < base:  # the rows from the kept one above row i on
            base = (i - 1) // every * every
            rows = [kept[base // every]]
            for k in range(base + 1, min(base + every, m) + 1):
                rows.append(_next_row(rows[-1], item[k - 1], passage, steps))
        here, up = rows[i - base], rows[i - 1 - base]
        if here[j] <= 0:
            break
        same = MATCH if j and item[i - 1] == passage[j - 1] else MISMATCH
        if j and here[j] == up[j - 1] + same:
            matched += int(same > 0)
            i, j = i - 1, j - 1
        elif here[j] == up[j] + GAP:
            i -= 1
        else:
            j -= 1
    return best, matched, j, stop


def contaminated(docs: DataFrame, benchmark: DataFrame, *, min_score: float = MIN_SCORE, held_grams: int = HELD_GRAMS) -> DataFrame:
    """(doc_id, item_id, score, matched, item_words, start, n_words, passage): the
    best alignment of each document and item that reaches ``min_score``.

    score: matched words / words of the item, at least MIN_WORDS of them: a shorter
    item, such as "yes", is no evidence and matches nothing. start and n_words place the
    aligned words in the document; passage is its text in lower case. Null texts and items
    without words match nothing; rows that share a document id count as one
    document, of which the best alignment counts; an empty table on either side
    gives an empty result.
    """
    spark = docs.sparkSession
    workers_import_this(spark)
    doc_kind, item_kind = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    items = item_words(benchmark, min_score)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = f"doc_id {doc_kind}, item_id {item_kind}, score double, matched long, item_words long, start long, n_words long, passage string"
    n_words = items.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    held = n_words <= held_grams
    index = checkpoint(rarest(docs, items, held))
    out = (_held if held else _joined)(docs, items, index, schema, min_score)
    best = out.groupBy("doc_id", "item_id").agg(F.max(F.struct("score", "matched", "item_words", (-F.col("start")).alias("before"), "n_words", "passage")).alias("b"))
    return best.select("doc_id", "item_id", "b.score", "b.matched", "b.item_words", (-F.col("b.before")).alias("start"), "b.n_words", "b.passage")
