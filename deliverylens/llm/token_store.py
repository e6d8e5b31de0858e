"""Token-id files: one zstandard frame a document under a shared dictionary.

A shard is

    MAGIC | sha256 of the dictionary (32 bytes) | frames ... | index | length of
    the index (8 bytes, little-endian) | MAGIC

where a frame is the compressed array of a document's ids (little-endian
unsigned 16-bit, or 32-bit for vocabularies over 65,536) and the index an Arrow
stream (doc_id, offset, size, n_tokens, width). A reader gets one document with
the index and one short read. The dictionary lies beside the shards, named by
its hash; a shard whose hash differs is refused.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import files
from .session import checkpoint, drop_shuffles, scratch, workers_import_this
from .tokens import encoded, encoder

MAGIC = b"DLTOK1\r\n"
SAMPLE_DOCS, SAMPLE_CHARS, DICTIONARY_BYTES = 2000, 8192, 65536
LEVEL = 3


def serialise(ids: bytes, wide: bool) -> bytes:
    """Little-endian 32-bit ids in the width of the file."""
    return ids if wide else np.frombuffer(ids, dtype="<u4").astype("<u2").tobytes()


def train(docs: DataFrame, vocabulary: str, byte_level: bool, end: bytes, wide: bool, id_col: str, text_col: str) -> bytes:
    """A dictionary from the starts of at most SAMPLE_DOCS documents, chosen by
    a hash of the id: at most SAMPLE_DOCS * SAMPLE_CHARS characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary, byte_level)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([serialise(ids + end, wide) for ids in coder.encode_many(batch.column(0).to_pylist())], pa.binary())], names=["a"])

    # A threshold on the hash first: about four times SAMPLE_DOCS rows are sorted, however many there are.
    share = min(1.0, 4 * SAMPLE_DOCS / max(1, docs.count()))
    some = docs.select(F.xxhash64(id_col, text_col).alias("o"), F.substring(F.col(text_col).cast("string"), 1, SAMPLE_CHARS).alias("text"))
    few = some.where(F.pmod("o", F.lit(1 << 32)) < int(share * (1 << 32))).orderBy("o", "text").limit(SAMPLE_DOCS)
    samples = [bytes(r.a) for r in few.select("text").mapInArrow(run, "a binary").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples: their bytes are the dictionary
        return b"".join(samples)[:DICTIONARY_BYTES]


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    if not raw:
        return None
    out = zstandard.ZstdCompressionDict(raw)
    out.precompute_compress(level=LEVEL)  # else each frame would load it anew
    return out


class ShardWriter:
    """Appends documents to an open stream."""

    def __init__(self, out, dictionary: bytes, wide: bool):
        self.out, self.wide, self.at = out, wide, 0
        self.packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary))
        self.index: list[tuple] = []
        self._put(MAGIC + hashlib.sha256(dictionary).digest())

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, doc, ids: bytes) -> None:
        frame = self.packer.compress(serialise(ids, self.wide))
        self.index.append((doc, self.at, len(frame), len(ids) // 4, 4 if self.wide else 2))
        self._put(frame)

    def close(self, kind: pa.DataType) -> None:
        cols = list(zip(*self.index)) or [[]] * 5
        table = pa.table([pa.array(c, k) for c, k in zip(cols, [kind, pa.int64(), pa.int64(), pa.int64(), pa.int8()])], names=["doc_id", "offset", "size", "n_tokens", "width"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
            w.write_table(table)
        raw = sink.getvalue().to_pybytes()
        self._put(raw + len(raw).to_bytes(8, "little") + MAGIC)


class ShardReader:
    """Random access to one shard."""

    def __init__(self, uri: str, dictionary: bytes):
        self.file = files.open_file(uri)
        size = self.file.size()
        head = self.file.read_at(len(MAGIC) + 32, 0)
        tail = self.file.read_at(8 + len(MAGIC), size - 8 - len(MAGIC))
        if head[: len(MAGIC)] != MAGIC or tail[8:] != MAGIC:
            raise ValueError(f"{uri} is not a token shard")
        if head[len(MAGIC) :] != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{uri} was written with another dictionary")
        n = int.from_bytes(tail[:8], "little")
        self.index = pa.ipc.open_stream(self.file.read_at(n, size - 8 - len(MAGIC) - n)).read_all()
        self.unpacker = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def documents(self) -> Iterator[tuple]:
        """(doc_id, ids as uint32 array) in the file's order."""
        for row in self.index.to_batches(max_chunksize=1024):
            for doc, offset, size, n, width in zip(*(row.column(i).to_pylist() for i in range(5))):
                yield doc, self._ids(offset, size, n, width)

    def get(self, doc) -> list[np.ndarray]:
        """The id arrays of one document (several if its id is repeated)."""
        rows = self.index.filter(pa.compute.equal(self.index["doc_id"], doc)).to_pylist()
        return [self._ids(r["offset"], r["size"], r["n_tokens"], r["width"]) for r in rows]

    def _ids(self, offset: int, size: int, n: int, width: int) -> np.ndarray:
        raw = self.unpacker.decompress(self.file.read_at(size, offset), max_output_size=n * width)
        return np.frombuffer(raw, dtype=f"<u{width}").astype("<u4")

    def close(self) -> None:
        self.file.close()


@lru_cache(maxsize=4)
def _dictionary_at(folder: str, sha: str) -> bytes:
    return files.read_file(f"{folder}/dictionary-{sha}.zstd")


def write(docs: DataFrame, folder: str, vocabulary: str, *, byte_level: bool = True, end_id: int = 0, wide: bool = False, shard_bytes: int = 64 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write shards in ascending order of the id and return the manifest:
    (shard, path, n_docs, n_tokens, dictionary), one row a shard.

    ``folder`` must be reachable from all executors. A null text counts as
    empty; null ids come first; rows with one id follow in the order of their
    texts' hashes. An empty table gives an empty manifest.
    """
    spark = docs.sparkSession
    workers_import_this(spark)
    end = end_id.to_bytes(4, "little")
    files.make_dir(folder)
    dictionary = train(docs, vocabulary, byte_level, end, wide, id_col, text_col)
    sha = hashlib.sha256(dictionary).hexdigest()
    with files.new_file(f"{folder}/dictionary-{sha}.zstd") as out:
        out.write(dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = encoder(vocabulary, byte_level), TaskContext.get().partitionId()
        flow = ((doc, ids + end, b.schema.field(0).type) for b in batches for doc, ids in encoded([b], coder))
        held, number = next(flow, None), 0
        while held is not None:
            shard = (part << 24) + number
            path, tokens, docs_in = f"{folder}/shard-{shard:012x}.tok", 0, 0
            with files.new_file(path) as out:
                writer = ShardWriter(out, _dictionary_at(folder, sha), wide)
                while held is not None and writer.at < shard_bytes:
                    doc, ids, kind = held
                    writer.add(doc, ids)
                    tokens, docs_in = tokens + len(ids) // 4, docs_in + 1
                    held = next(flow, None)
                writer.close(kind)
            number += 1
            yield pa.RecordBatch.from_pylist([{"shard": shard, "path": path, "n_docs": docs_in, "n_tokens": tokens, "dictionary": sha}])

    ordered = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.xxhash64(text_col).alias("o"))
    ordered = ordered.repartitionByRange("id", "o").sortWithinPartitions("id", "o").select("id", "text")
    manifest = checkpoint(ordered.mapInArrow(run, "shard long, path string, n_docs long, n_tokens long, dictionary string"))
    del ordered
    drop_shuffles(spark)
    return manifest


def _tasks(manifest: DataFrame) -> int:
    """Partitions to read the shards in: one a shard while cores are free, then four shards each."""
    shards, cores = manifest.count(), manifest.sparkSession.sparkContext.defaultParallelism
    return max(1, min(2 * shards, cores), shards // 4)


def read(manifest: DataFrame, folder: str, id_type: str = "bigint") -> DataFrame:
    """Decode the shards: (doc_id, start, n_tokens, ids_crc32) a document.

    ``start`` counts the ids of all documents before it, over all shards; the
    crc is of the ids as little-endian unsigned 32-bit integers.
    """
    workers_import_this(manifest.sparkSession)
    schema = f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                reader, at, rows = ShardReader(r["path"], _dictionary_at(folder, r["dictionary"])), r["before"], []
                kind = reader.index.schema.field("doc_id").type
                for doc, ids in reader.documents():
                    rows.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
                    at += len(ids)
                reader.close()
                cols = list(zip(*rows)) or [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], kind), *(pa.array(c, pa.int64()) for c in cols[1:])], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    # A shard's number begins with its write task's: tokens are summed inside each task's shards, and over
    # the tasks' totals, which are as few as the partitions of the write.
    part = F.shiftright("shard", 24)
    tasks = manifest.groupBy(part.alias("part")).agg(F.sum("n_tokens").alias("n"))
    tasks = tasks.select("part", F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("earlier"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    sums = manifest.withColumn("part", part).withColumn("inside", inside).join(tasks, "part")
    sums = sums.select("shard", "path", "dictionary", (F.coalesce("earlier", F.lit(0)) + F.coalesce("inside", F.lit(0))).alias("before"))
    return sums.repartition(_tasks(manifest), "shard").select("path", "before", "dictionary").mapInArrow(run, schema)


def round_trip(spark: SparkSession, docs: DataFrame, vocabulary: str) -> DataFrame:
    """Write all documents to a new folder and read them back."""
    folder = scratch(spark, "tokens")
    return read(write(docs, folder, vocabulary), folder, docs.schema["doc_id"].dataType.simpleString())
