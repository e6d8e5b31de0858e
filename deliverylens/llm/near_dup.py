"""Near-duplicate documents: SimHash, then an exact join of their sets of five-word shingles.

Two documents are linked if the Jaccard similarity of their sets is at least
``similarity``, and every such pair is met. SimHash comes first, with the
fingerprints and links of simhash.py: sets whose fingerprints are equal or at
most MAX_BITS apart are compared, each with the smallest and the nearest of
those. Similar sets can lie farther apart, so a join finds all others.

In one order of all shingles, two sets that similar share one of the first
n - ceil(similarity * n) + 1 of each: these few are a set's keys (prefix filter).
Shingles that are frequent in a sample come last in the order, which keeps the
buckets of a key small and changes no result. Sets that share a key are compared if their sizes, and what
follows the key in each, leave room for the similarity, and if their bitmaps
do: each shingle flips one bit, so that two sets differ in at least as many
shingles as their bitmaps do in bits. The whole sets decide.

Of the smallest members of its buckets each set is compared with the smallest
and with the nearest by bitmap first, so that large groups of copies are linked
in at most two pairs a set. Then all pairs of a bucket are compared that these
links have not put into one group: none is left out. That join reads bitmaps of
one size itself, so that it gives out only pairs with room for the similarity.
The buckets of frequent shingles are summed up by map-side minima and sent to
all tasks (FREQUENT rows at most), so that no task gets such a bucket whole to
find its smallest member.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import simhash
from . import words as W
from .components import components
from .session import checkpoint, drop_shuffles, workers_import_this

SHINGLE, SIMILARITY = 5, 0.8
#: In how many bits fingerprints may differ to be linked, as in op4.
MAX_BITS = 2
#: The order of shingles is told from so many documents; it holds so many frequent ones (8 bytes each).
SAMPLE_DOCS, FREQUENT = 10_000, 100_000
#: Ids that are sent to all tasks (8 bytes each); with more, the texts are shuffled.
SENT_IDS = 1_000_000
#: Against rounding: bounds are this much wider than the similarity, which alone decides.
_SLACK = 1e-6
#: Words of the bitmap that has one size for all sets.
FOLD = 8


def shingles(text: str | None) -> np.ndarray:
    """The hashes of the different runs of SHINGLE words of the text, A-Z
    lower-cased, sorted; a text with fewer words is one run, one without words none."""
    buf = np.frombuffer((text or "").encode().lower(), dtype=np.uint8)
    h = W.word_hashes(buf, *W.spans(buf))
    return np.unique(W.window_hashes(h, min(SHINGLE, len(h))).view(np.int64)) if len(h) else np.zeros(0, dtype=np.int64)


def unit_of(found: np.ndarray) -> int:
    """One number for a set of shingles: equal sets have equal ones."""
    h = found.view(np.uint64)
    return int(W.mix(W.range_hashes(W.mix(h), np.array([0]), np.array([len(h)]))).view(np.int64)[0])


def bitmap(found: np.ndarray, n: int = 0) -> bytes:
    """A power of two of bits (n, else two to four a shingle): how many shingles fall on each, modulo 2."""
    n = n or 1 << max(6, (2 * len(found)).bit_length())
    odd = np.bincount((found.view(np.uint64) & np.uint64(n - 1)).astype(np.int64), minlength=n) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def differ(a: bytes, b: bytes) -> int:
    """In how many bits two bitmaps differ; the longer one is folded to the other's size."""
    x, y = np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64)
    n = min(len(x), len(y))
    each = np.bitwise_xor.reduce(x.reshape(-1, n), axis=0) ^ np.bitwise_xor.reduce(y.reshape(-1, n), axis=0)
    return int(np.bitwise_count(each).sum())


def n_keys(n: int, similarity: float) -> int:
    return n - max(1, int(np.ceil(similarity * n - _SLACK))) + 1 if n else 0


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))


def _sets(texts: DataFrame) -> DataFrame:
    """(u, found): the set of shingles of each text of (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                found = [shingles(t.as_py()) for t in batch.column(1).slice(at, 256)]
                yield pa.RecordBatch.from_arrays([pa.array([unit_of(x) for x in found], pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["u", "found"])

    return texts.mapInArrow(run, "u long, found array<long>")


def frequent(texts: DataFrame) -> np.ndarray:
    """Shingles of two or more different sets of a sample, the most frequent first."""
    step = max(1, texts.count() // SAMPLE_DOCS)
    some = _sets(texts.where(F.pmod(F.xxhash64("id"), F.lit(step)) == 0)).dropDuplicates(["u"])
    often = some.select(F.explode("found").alias("g")).groupBy("g").agg(F.count("*").alias("c")).where("c > 1")
    return np.array([r.g for r in often.orderBy(F.desc("c"), "g").limit(FREQUENT).collect()], dtype=np.int64)


def keyed(texts: DataFrame, similarity: float) -> DataFrame:
    """(id, u, n, keys, n_rare, bits, fold, fp): the set of each text by number and size, its first
    shingles in order, of which n_rare aren't frequent, its bitmaps: by its size, and of FOLD words, and
    its SimHash fingerprint."""
    last = frequent(texts)
    order = np.argsort(last, kind="stable")
    known, rank = last[order], (len(last) - np.arange(len(last)))[order]

    def first(found: np.ndarray) -> tuple[np.ndarray, int]:
        late = np.zeros(len(found), dtype=np.int64)
        if len(known):
            at = np.minimum(np.searchsorted(known, found), len(known) - 1)
            late = np.where(known[at] == found, rank[at], 0)
        n = n_keys(len(found), similarity)
        return found[np.lexsort((found, late))][:n], min(n, int((late == 0).sum()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [shingles(t) for t in texts]
            keys = [first(x) for x in found]
            fps = np.array([simhash.fingerprint(simhash.shingle_hashes(t, SHINGLE)) for t in texts], dtype=np.uint64)
            cols = [pa.array([unit_of(x) for x in found], pa.int64()), pa.array([len(x) for x in found], pa.int32()), pa.array([k for k, _ in keys], pa.list_(pa.int64())), pa.array([r for _, r in keys], pa.int32()), pa.array([bitmap(x) for x in found], pa.binary()), pa.array([np.frombuffer(bitmap(x, 64 * FOLD), dtype=np.int64) for x in found], pa.list_(pa.int64())), pa.array(fps.view(np.int64))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=["id", "u", "n", "keys", "n_rare", "bits", "fold", "fp"])

    return texts.mapInArrow(run, f"id {texts.schema['id'].dataType.simpleString()}, u long, n int, keys array<long>, n_rare int, bits binary, fold array<long>, fp long")


def by_fingerprint(reps: DataFrame) -> DataFrame:
    """(a, b), a < b: the sets of (u, fp) that SimHash proposes. The smallest set of a fingerprint
    stands for it: the others of the fingerprint meet it, and it meets those of the smallest and
    of the nearest of the linked fingerprints."""
    least = checkpoint(reps.groupBy("fp").agg(F.min("u").alias("least")))
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    two = F.array_distinct(F.array(F.min("a"), F.min_by("a", F.struct(apart, "a"))))
    linked = simhash.links(least, MAX_BITS).select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("x")).select("x.*")
    linked = linked.groupBy("b").agg(two.alias("a")).select(F.explode("a").alias("a"), "b")
    for x in "ab":
        linked = linked.join(least.select(F.col("fp").alias(x), F.col("least").alias(f"u_{x}")), x)
    linked = linked.select(F.least("u_a", "u_b").alias("a"), F.greatest("u_a", "u_b").alias("b"))
    equal = reps.join(least, "fp").where("u > least").select(F.col("least").alias("a"), F.col("u").alias("b"))
    return linked.union(equal).distinct()


def _may_be(a: dict[str, Column], b: dict[str, Column], similarity: float) -> Column:
    """Whether two sets whose first common shingle is this one can be similar enough."""
    most = F.least(a["n"] - a["pos"], b["n"] - b["pos"])
    return most >= similarity / (1 + similarity) * (a["n"] + b["n"]) - _SLACK


def _most(n_a: Column, n_b: Column, similarity: float) -> Column:
    """In how many shingles two sets of these sizes may differ."""
    return (1 - similarity) / (1 + similarity) * (n_a + n_b) + _SLACK


def _room(pairs: DataFrame, reps: DataFrame, similarity: float) -> DataFrame:
    """(a, b, d): the pairs whose bitmaps leave room for the similarity; d is in how
    many bits they differ, by what they may."""
    for x in "ab":
        pairs = pairs.join(reps.select(F.col("u").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}")), x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = np.array([differ(x, y) for x, y in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())], dtype=np.float64)
            d /= batch.column(2).to_numpy()
            found = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(d)], names=["a", "b", "d"])
            yield found.filter(pa.array(d <= 1))

    most = _most(F.col("n_a"), F.col("n_b"), similarity).cast("double").alias("most")
    return pairs.select("a", "b", most, "bits_a", "bits_b").mapInArrow(run, "a long, b long, d double")


def _spread(rows: DataFrame, least: str, most: str) -> DataFrame:
    """The rows of (k, frequent, ...) with lo and hi, the least value of ``least``
    and the greatest of ``most`` over the bucket; buckets where these are one are left out."""
    rare = rows.where("NOT frequent").selectExpr("*", f"min({least}) OVER (PARTITION BY k) AS lo", f"max({most}) OVER (PARTITION BY k) AS hi")
    hot = rows.where("frequent")
    ends = hot.groupBy("k").agg(F.expr(f"min({least})").alias("lo"), F.expr(f"max({most})").alias("hi"))
    return rare.unionByName(hot.join(F.broadcast(ends), "k"))


def _sets_of(wanted: DataFrame, texts: DataFrame, reps: DataFrame) -> DataFrame:
    """(u, found) of the wanted sets, read from the texts again; rows may repeat."""
    ids = checkpoint(wanted.join(reps.select("u", "id"), "u").select("id").distinct())
    return checkpoint(_sets(texts.join(F.broadcast(ids) if ids.count() <= SENT_IDS else ids, "id", "left_semi")))


def _similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of sets whose similarity is at least the given one, by their whole sets."""
    a, b = (sets.select(F.col("u").alias(x), F.col("found").alias(f"found_{x}")) for x in "ab")
    both = F.size(F.array_intersect("found_a", "found_b"))
    near = pairs.join(a, "a").join(b, "b").where(both / (F.size("found_a") + F.size("found_b") - both) >= similarity)
    return near.select("a", "b").distinct()


def _members(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("u")).distinct()


def groups(docs: DataFrame, *, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, group_id): group_id is the smallest id of the document's group.

    Groups are the components of the pairs with a similarity of at least
    ``similarity``. Null texts and texts without words are alike. Null ids are
    left alone (group_id null); an empty table gives none.
    """
    spark = docs.sparkSession
    workers_import_this(spark)
    texts = _texts(docs, id_col, text_col)
    alone = texts.where("id IS NULL").select("id", F.col("id").alias("group_id"))
    texts = texts.where("id IS NOT NULL")
    found = checkpoint(keyed(texts, similarity))
    units = found.groupBy("u").agg(*(F.first(c).alias(c) for c in ("n", "keys", "n_rare")))
    reps = checkpoint(found.groupBy("u").agg(F.min("id").alias("id"), F.min("fp").alias("fp"), *(F.first(c).alias(c) for c in ("n", "bits", "fold"))))
    each = units.select("u", "n", "n_rare", F.posexplode("keys").alias("pos", "k")).select("k", "u", "n", "pos", F.expr("pos >= n_rare").alias("frequent"))
    met = checkpoint(_spread(each, "struct(u, n, pos)", "u").where("lo.u != hi").drop("hi"))
    drop_shuffles(spark)
    row = {c: F.col(c) for c in ("n", "pos")}
    led = met.where(F.col("u") != F.col("lo.u")).where(_may_be({c: F.col(f"lo.{c}") for c in row}, row, similarity))
    led = _room(led.select(F.col("lo.u").alias("a"), F.col("u").alias("b")).distinct(), reps, similarity)
    two = F.array_distinct(F.array(F.min("a"), F.min_by("a", F.struct("d", "a"))))
    led = led.groupBy("b").agg(two.alias("a")).select(F.explode("a").alias("a"), "b")
    hashed = _room(by_fingerprint(reps.select("u", "fp")), reps, similarity).select("a", "b")
    led = checkpoint(hashed.union(led).distinct())
    drop_shuffles(spark)
    sets = _sets_of(_members(led), texts, reps)
    links = checkpoint(_similar(led, sets, similarity))
    drop_shuffles(spark)
    comp = checkpoint(components(links))
    drop_shuffles(spark)
    placed = met.drop("lo").join(comp.withColumnRenamed("node", "u"), "u", "left").withColumn("c", F.coalesce("component", "u")).drop("component")
    apart = _spread(placed, "c", "c").where("lo != hi").drop("lo", "hi")
    folds = [F.col("fold")[i].alias(f"w{i}") for i in range(FOLD)]
    apart = checkpoint(apart.join(reps.select("u", *folds), "u"))
    x, y = (apart.select("k", *(F.col(c).alias(f"{c}_{s}") for c in ("u", "n", "pos", "c", *(f"w{i}" for i in range(FOLD))))) for s in "xy")
    x_row, y_row = ({c: F.col(f"{c}_{s}") for c in row} for s in "xy")
    rest = x.join(y, "k").where("u_x < u_y AND c_x != c_y").where(_may_be(x_row, y_row, similarity))
    bits = sum((F.bit_count(F.col(f"w{i}_x").bitwiseXOR(F.col(f"w{i}_y"))) for i in range(FOLD)), F.lit(0))
    rest = rest.where(bits <= _most(F.col("n_x"), F.col("n_y"), similarity))
    rest = rest.select(F.col("u_x").alias("a"), F.col("u_y").alias("b")).distinct()
    rest = checkpoint(_room(rest, reps, similarity).select("a", "b").join(led, ["a", "b"], "left_anti"))
    drop_shuffles(spark)
    sets = sets.union(_sets_of(_members(rest).join(sets, "u", "left_anti"), texts, reps))
    drop_shuffles(spark)
    comp = components(links.union(_similar(rest, sets, similarity)))
    named = reps.select("u", "id").join(comp.withColumnRenamed("node", "u"), "u", "left").withColumn("c", F.coalesce("component", "u"))
    top = named.groupBy("c").agg(F.min("id").alias("group_id"))
    named = named.join(top, "c").select("u", "group_id")
    return found.select("id", "u").join(named, "u").select("id", "group_id").union(alone).withColumnRenamed("id", id_col)
