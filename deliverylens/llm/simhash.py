"""SimHash near-duplicates found by pigeonhole blocks.

A fingerprint is cut into four times as many blocks as bits may differ; two
fingerprints within that distance agree on all blocks but so many. Every choice
of agreeing blocks gives a key; fingerprints meet on equal keys and the Hamming
distance decides. Equal fingerprints are one row before they meet, and a bucket
holds only fingerprints that agree on three quarters of their bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .session import checkpoint, workers_import_this

SEED = 42
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_PLACE = np.arange(8, dtype=np.int64) * 256


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 of each run of ``size`` words of the text, A-Z lower-cased; a text
    with fewer words is one run, one without words none."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(line, SEED)], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - size + 1
    return np.fromiter((digest(line[s:e], SEED) for s, e in zip(starts[:n].tolist(), ends[size - 1 :].tolist())), dtype=np.uint64, count=n)


def fingerprint(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes; zero for none."""
    if not len(hashes):
        return 0
    seen = np.bincount((hashes.view(np.uint8).reshape(-1, 8) + _PLACE).ravel(), minlength=2048).reshape(8, 256)
    most = (seen @ _BITS).ravel() * 2 > len(hashes)
    return int(np.packbits(most, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) of every document; fp is the 64-bit pattern as a long.

    A null text has no words: fingerprint zero.
    """
    workers_import_this(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(shingle_hashes(t.as_py(), shingle)) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, fp long").withColumnRenamed("id", id_col)


def _masks(max_bits: int, n: int) -> list[int]:
    """For every choice of blocks, of n, that may differ, the bits of the others (signed)."""
    edges = [round(64 * k / n) for k in range(n + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    out = [~sum(blocks[k] for k in c) & (2**64 - 1) for c in combinations(range(n), max_bits)]
    return [m - 2**64 if m >= 2**63 else m for m in out]


def block_keys(fps: DataFrame, max_bits: int, blocks: int | None = None) -> DataFrame:
    """fps (with column fp) once for each choice c of agreeing blocks, with their bits as key k."""
    masks = F.array(*[F.lit(m) for m in _masks(max_bits, blocks or 4 * max_bits)])
    return fps.select("*", F.posexplode(masks).alias("c", "m")).withColumn("k", F.col("fp").bitwiseAND(F.col("m"))).drop("m")


def links(fps: DataFrame, max_bits: int = 2, blocks: int | None = None) -> DataFrame:
    """(a, b), a < b: the distinct fingerprints of column fp at most so many bits apart.

    blocks: into how many a fingerprint is cut, four times max_bits unless
    given; with fewer there are fewer keys, of fewer bits each.

    A fingerprint has at most 2,080 neighbours within two bits, so the links
    grow with the fingerprints and not with the square of a group. Both sides are
    shuffled and sorted: Spark sizes the keys as the fingerprints before they are
    exploded, and would broadcast many times what it may.
    """
    if max_bits < 1:
        raise ValueError("equal fingerprints need no links")
    keyed = block_keys(fps.select("fp").distinct(), max_bits, blocks)
    left, right = keyed.withColumnRenamed("fp", "a"), keyed.select(F.col("fp").alias("b"), F.col("c").alias("c2"), F.col("k").alias("k2"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return left.join(right.hint("merge"), (F.col("k") == F.col("k2")) & (F.col("c") == F.col("c2")) & (F.col("a") < F.col("b")) & close).select("a", "b")


def groups(docs: DataFrame, *, shingle: int = 5, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component_id): component_id is the smallest id whose fingerprint
    links to this one's over any number of steps, equal fingerprints included.

    Null texts and texts without words share fingerprint zero and link like any
    other. Null ids are kept, and never the smallest unless there is no other.
    Repeated ids keep their rows. An empty table gives an empty result.
    """
    found = checkpoint(fingerprints(docs, shingle, id_col, text_col))
    each = found.groupBy("fp").agg(F.min(id_col).alias("least"))
    comp = components(links(each, max_bits)).withColumnRenamed("node", "fp")
    rooted = each.join(comp, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("root"))
    top = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(top, "root").select("fp", "component_id")
    return found.join(named, "fp").select(id_col, "fp", "component_id")


def hex_of(fp: str):
    """A fingerprint as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
