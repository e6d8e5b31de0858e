"""Hierarchical multi-length packing of token ids.

Every document is cut into windows of the longest context; what is left over
is routed to the tier (context size) that just holds it. Each tier opens
sequences for its own pieces and fills their gaps from shorter tiers, largest
fitting piece first, cutting one only where none fits. Sequences of one
context size are dealt into step groups of the same number of tokens; those
that are left over at the end of a partition are dealt largest first, each to
the group with fewest tokens.

Packing runs inside each input partition in a stream, without a shuffle; a
task keeps a bounded buffer of remainders. What a partition has left at its end
goes into sequences of falling powers of two below the shortest tier, so that
nothing is padded, however small the partitions are.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_right, insort
from collections import defaultdict
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .session import workers_import_this
from .tokens import encoded, encoder

TIERS = (128, 256, 512, 1024, 2048)
BUFFER = 4096
PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, context int, step_group long"


class TierPacker:
    """Packs (document, id bytes) given one after another.

    ``emit(doc, start, length, crc, doc_tokens, sequence, offset, context, step)``
    is called for each piece of a closed sequence. The documents' order decides
    the result; nothing else does.
    """

    def __init__(self, emit: Callable, first_sequence: int = 0, tiers: tuple[int, ...] = TIERS, step_tokens: int = 16384, buffer: int = BUFFER):
        self.tiers, self.emit, self.buffer = tuple(sorted(tiers)), emit, buffer
        self.longest = self.tiers[-1]
        self.first, self.made = first_sequence, 0
        self.step_tokens, self.new_step = step_tokens, first_sequence
        #: By context, sequences (context, pieces) whose step group isn't full yet.
        self.open: dict[int, list] = defaultdict(list)
        self.pools: dict[int, list] = {t: [] for t in self.tiers}
        self.waiting = 0
        self.serial = 0

    def add(self, doc, ids: bytes) -> None:
        n, at = len(ids) // 4, 0
        while n - at >= self.longest:
            self._close([(doc, at, self.longest, ids[4 * at : 4 * (at + self.longest)], n)], self.longest)
            at += self.longest
        if at < n:
            self._pool(doc, at, ids[4 * at :], n)
            if self.waiting >= self.buffer:
                self._pack(last=False)

    def finish(self) -> None:
        self._pack(last=True)
        left = [x for c in sorted(self.open, reverse=True) for x in self.open[c]]
        self.open.clear()
        groups = [(0, k, []) for k in range(-(-sum(c for c, _ in left) // self.step_tokens))]
        for context, pieces in left:
            total, k, held = heapq.heappop(groups)
            heapq.heappush(groups, (total + context, k, [*held, (context, pieces)]))
        for _, _, held in sorted(groups, key=lambda g: g[1]):
            self._step(held)

    def _pool(self, doc, start: int, ids: bytes, n: int) -> None:
        length = len(ids) // 4
        tier = next(t for t in self.tiers if t >= length)
        self.serial += 1
        insort(self.pools[tier], (length, self.serial, doc, start, ids, n), key=lambda x: x[:2])
        self.waiting += 1

    def _take(self, most: int) -> tuple | None:
        """The longest waiting piece of at most so many ids."""
        for t in reversed(self.tiers):
            pool = self.pools[t]
            if pool and pool[0][0] <= most:
                k = bisect_right(pool, most, key=lambda x: x[0]) - 1
                self.waiting -= 1
                return pool.pop(k)
        return None

    def _cut(self, size: int) -> tuple | None:
        """The first ``size`` ids of the shortest waiting piece that has more; its rest waits."""
        for t in self.tiers:
            pool = self.pools[t]
            if pool:
                k = bisect_right(pool, size, key=lambda x: x[0])
                if k < len(pool):
                    length, _, doc, start, ids, n = pool.pop(k)
                    self.waiting -= 1
                    self._pool(doc, start + size, ids[4 * size :], n)
                    return (doc, start, size, ids[: 4 * size], n)
        return None

    def _fill(self, context: int) -> list:
        """Pieces for one sequence of this context size, from what waits."""
        pieces, gap = [], context
        while gap:
            got = self._take(gap)
            if got:
                piece = (got[2], got[3], got[0], got[4], got[5])
            else:
                piece = self._cut(gap)
                if piece is None:
                    break
            pieces.append(piece)
            gap -= piece[2]
        return pieces

    def _pack(self, last: bool) -> None:
        """Long tiers first; unless it is the last call, a quarter of the buffer
        stays so that later gaps find short pieces."""
        keep = 0 if last else self.buffer // 4
        for context in reversed(self.tiers):
            while self.pools[context] and self.waiting > keep and (self._tokens() >= context):
                self._close(self._fill(context), context)
        while last and self.waiting:
            held = self._tokens()
            size = max((t for t in self.tiers if t <= held), default=1 << (held.bit_length() - 1))
            self._close(self._fill(size), size)

    def _tokens(self) -> int:
        """Waiting ids, counted up to the longest context."""
        total = 0
        for t in reversed(self.tiers):
            for x in self.pools[t]:
                total += x[0]
                if total >= self.longest:
                    return total
        return total

    def _close(self, pieces: list, context: int) -> None:
        sequence, offset, rows = self.first + self.made, 0, []
        self.made += 1
        for doc, start, length, ids, n in pieces:
            rows.append((doc, start, length, zlib.crc32(ids), n, sequence, offset, context))
            offset += length
        held = self.open[context]
        held.append((context, rows))
        if len(held) >= max(1, self.step_tokens // context):
            self._step(held)
            self.open[context] = []

    def _step(self, sequences: list) -> None:
        """Emit the pieces of sequences as one step group."""
        for _, rows in sequences:
            for row in rows:
                self.emit(*row, self.new_step)
        self.new_step += 1


def pack(docs: DataFrame, vocabulary: str, *, byte_level: bool = False, end_id: int = 1, tiers: tuple[int, ...] = TIERS, step_tokens: int = 16384, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a piece: id, PIECES.

    A null or empty text is its end id alone; repeated ids are documents of
    their own; an empty table gives no rows. ``context`` is the sequence's
    size, ``step_group`` its group; both are unique over partitions. A group has
    step_tokens tokens, but for a partition's last ones, which differ from each
    other by one sequence at most. Every sequence is full: contexts are the tiers
    and, at the end of a partition, powers of two below the shortest.
    """
    workers_import_this(docs.sparkSession)
    names = [x.split()[0] for x in PIECES.split(", ")]
    end = end_id.to_bytes(4, "little")
    kinds = [pa.int64()] * 6 + [pa.int32(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary, byte_level)
        rows: list[tuple] = []
        kind = None

        def out() -> pa.RecordBatch:
            cols = list(zip(*rows))
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(cols[0], kind), *(pa.array(c, k) for c, k in zip(cols[1:], kinds))], names=["id", *names])

        packer = TierPacker(lambda *x: rows.append(x), TaskContext.get().partitionId() << 40, tiers, step_tokens)
        for batch in batches:
            kind = batch.schema.field(0).type
            for doc, ids in encoded([batch], coder):
                packer.add(doc, ids + end)
                if len(rows) >= 20000:
                    yield out()
        packer.finish()
        if rows:
            yield out()

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, {PIECES}")
    return out.withColumnRenamed("id", id_col)
