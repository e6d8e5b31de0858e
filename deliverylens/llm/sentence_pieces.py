"""SentencePiece encoding and decoding of whole texts by vectorised merge rounds.

A text is a flat numpy array of symbols, cut where no piece of the model can
reach across (before a space, and between two characters that stand side by side
in no piece); these words merge independently of one another. In each round
every word finds its best pair (segmented minimum of the pairs' ranks), the
leftmost such pair of each word is merged, all words at once, and the arrays are
compacted, until no pair is left. Words come back often, so a worker keeps the ids
of those it has met in a bounded table, by a 64-bit hash.

A word of more than ``SHORT`` symbols is not one segment: there a pair merges as soon
as it is the best within the reach of the longest piece on either side. Nothing
farther away can touch it before: a piece that grows from outside that reach to
the pair would be longer than any piece. So a word of a million characters takes
about as many rounds as one of a hundred.
"""

from __future__ import annotations

import re
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .session import workers_import_this
from .tokens import MAX_WORDS, _Table

SPACE = "▁"
NONE = np.int32(2**30)  # the rank of a pair that makes no piece
SHORT = 64
#: Characters that go through the arrays at a time; a longer text is cut between words.
CHUNK = 400_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BETWEEN = re.compile(f"[^ {SPACE}](?=[ {SPACE}])")


class Pairs(NamedTuple):
    """What two symbols make: sorted keys (left * n_symbols + right), ranks, products."""

    keys: np.ndarray
    ranks: np.ndarray
    makes: np.ndarray
    n: int

    def of(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, product) of each pair; NONE and 0 where the two make no piece."""
        key = left.astype(np.int64) * self.n + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.ranks[at], NONE), np.where(hit, self.makes[at], 0)


class Coder:
    """A BPE model's tables. Models that normalise texts, that have pieces with a
    space behind another character, or user-defined or unused pieces are refused."""

    def __init__(self, path: str):
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = n = p.get_piece_size()
        names = [p.id_to_piece(k) for k in range(n)]
        plain = [k for k in range(n) if not (p.is_control(k) or p.is_unknown(k) or p.is_byte(k))]
        probe = " a  ﬁ Ａ "
        if any(p.is_unused(k) for k in plain) or p.decode(p.encode(probe)) != probe or not p.encode("a", out_type=str)[0].startswith(SPACE):
            raise ValueError("only models without normalisation and unused pieces are supported")
        of = {names[k]: k for k in plain}
        if any(SPACE in name.lstrip(SPACE) for name in of):
            raise ValueError("pieces with a space behind another character are not supported")
        self.reach = max(map(len, of))
        chars = sorted(set("".join(of)) | {SPACE})
        self.symbols = dict(of)
        for c in chars:
            self.symbols.setdefault(c, n + len(self.symbols) - len(of))
        n_symbols = n + len(self.symbols) - len(of)
        scores = {k: p.get_score(k) for k in plain}
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        found: dict[int, tuple[int, int]] = {}
        beside = np.zeros((len(chars) + 1, len(chars) + 1), dtype=bool)
        number = {c: k + 1 for k, c in enumerate(chars)}
        for name, k in of.items():
            for cut in range(1, len(name)):
                beside[number[name[cut - 1]], number[name[cut]]] = True
                a, b = self.symbols.get(name[:cut]), self.symbols.get(name[cut:])
                if a is not None and b is not None:
                    found[a * n_symbols + b] = (order[scores[k]], k)
        keys = np.array(sorted(found), dtype=np.int64)
        self.pairs = Pairs(keys, np.array([found[k][0] for k in keys.tolist()], dtype=np.int32), np.array([found[k][1] for k in keys.tolist()], dtype=np.int64), n_symbols)
        #: By code point: the number of a character that some piece has (else 0), and its symbol (else -1).
        self.number, self.symbol = np.zeros(0x110000, dtype=np.int16), np.full(0x110000, -1, dtype=np.int64)
        for c, k in number.items():
            self.number[ord(c)], self.symbol[ord(c)] = k, self.symbols[c]
        self.beside = beside
        self.run = self._space_run(p, of, scores)
        self.bytes = np.array(sorted((k for k in range(n) if p.is_byte(k)), key=lambda k: int(names[k][3:5], 16)), dtype=np.int64)
        self.unknown = p.unk_id()
        self.lone = {s: c for c, s in self.symbols.items() if s >= n}
        self.table = _Table()
        self._decoding(p, names)

    def _space_run(self, p, of: dict[str, int], scores: dict[int, float]) -> int:
        """How many spaces the longest piece of spaces has, if spaces only pair after
        all else and from the left, so that a run is cut into such pieces; else 0."""
        runs = {len(name): scores[k] for name, k in of.items() if set(name) == {SPACE} and len(name) > 1}
        others = [scores[k] for name, k in of.items() if set(name) != {SPACE}]
        mixed = any(SPACE * 2 in name and set(name) != {SPACE} for name in of)
        if not runs or mixed or len(set(runs.values())) > 1 or next(iter(runs.values())) >= min(others):
            return 0
        most = max(runs)
        return most if p.encode(" " * (3 * most - 1)) == 3 * [of[SPACE * most]] else 0

    # encoding

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text, as the library gives them without begin and end; none for null or empty."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        part: list[tuple[int, str]] = []
        held = 0
        for k, text in enumerate(texts):
            if not text:
                continue
            for piece in _pieces(" " + text):
                part.append((k, piece))
                held += len(piece)
                if held >= CHUNK:
                    self._chunk(part, out)
                    part, held = [], 0
        self._chunk(part, out)
        return [np.concatenate(ids) if ids else np.zeros(0, dtype=np.int32) for ids in out]

    def _chunk(self, part: list[tuple[int, str]], out: list[list[np.ndarray]]) -> None:
        if not part:
            return
        cps = np.frombuffer("".join([t for _, t in part]).encode("utf-32-le"), dtype="<u4").astype(np.int64)
        cps[cps == 32] = ord(SPACE)
        begins = np.cumsum([0, *[len(t) for _, t in part]])
        starts = self._cuts(cps, begins[:-1])
        ends = np.append(starts[1:], len(cps))
        up, down = W._powers(len(cps))
        total = np.zeros(len(cps) + 1, dtype=np.uint64)
        np.cumsum(W.mix((cps + 1).astype(np.uint64) * _ODD) * up, out=total[1:])
        h = W.mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _ODD)
        h = np.where(h == 0, np.uint64(1), h)
        entry = self.table.find(h)
        new = np.flatnonzero(entry < 0)
        if len(new):
            if self.table.n + len(new) > MAX_WORDS:
                self.table.clear()
                new = np.arange(len(h))
            one = new[np.unique(h[new], return_index=True)[1]]
            self.table.add(h[one], self.merged(cps, starts[one], ends[one]))
            entry = self.table.find(h)
        size = self.table.size[entry]
        cum = np.concatenate(([0], np.cumsum(size)))
        ids = self.table.ids[np.repeat(self.table.start[entry] - cum[:-1], size) + np.arange(cum[-1])].astype(np.int32)
        edge = cum[np.searchsorted(starts, begins)]
        for (k, _), a, b in zip(part, edge[:-1].tolist(), edge[1:].tolist()):
            out[k].append(ids[a:b])

    def _cuts(self, cps: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Where words start: at each begin, and where no piece reaches across."""
        number = self.number[cps]
        cut = np.ones(len(cps), dtype=bool)
        cut[1:] = ~self.beside[number[:-1], number[1:]]
        cut[begins] = True
        space = cps == ord(SPACE)
        if self.run and np.any(space[1:] & space[:-1]):
            first = space.copy()
            first[1:] &= ~space[:-1]
            first[begins] = space[begins]
            at = np.flatnonzero(space)
            start = np.maximum.accumulate(np.where(first, np.arange(len(cps)), -1))[at]
            # only the last space of a run goes with what follows, those before it fill pieces from the left
            cut[at[((at - start) % self.run == 0) & (at > start)]] = True
        return np.flatnonzero(cut)

    def merged(self, cps: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        """The ids of each of the words cps[start:end]."""
        size = ends - starts
        out: list[np.ndarray] = [None] * len(starts)
        for mine, rounds in ((np.flatnonzero(size <= SHORT), self._rounds_short), (np.flatnonzero(size > SHORT), self._rounds_long)):
            if not len(mine):
                continue
            n = size[mine]
            cum = np.concatenate(([0], np.cumsum(n)))
            flat = cps[np.repeat(starts[mine] - cum[:-1], n) + np.arange(cum[-1])]
            symbols, word = rounds(np.where(self.symbol[flat] < 0, -2 - flat, self.symbol[flat]), np.repeat(np.arange(len(mine)), n))
            ids, of = self._ids(symbols, word)
            edge = np.searchsorted(of, np.arange(len(mine) + 1))
            for k, a, b in zip(mine.tolist(), edge[:-1].tolist(), edge[1:].tolist()):
                out[k] = ids[a:b]
        return out

    def _ids(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of symbols: pieces are their own; characters that are no piece become bytes."""
        odd = np.flatnonzero((symbols < 0) | (symbols >= self.size))
        if not len(odd):
            return symbols, word
        one = np.ones(len(symbols), dtype=np.int64)
        spelt = []
        for k in odd.tolist():
            s = int(symbols[k])
            raw = (self.lone[s] if s >= 0 else chr(-2 - s)).encode()
            ids = self.bytes[np.frombuffer(raw, dtype=np.uint8)] if len(self.bytes) else np.array([self.unknown])
            one[k] = len(ids)
            spelt.append(ids)
        out = np.repeat(symbols, one)
        at = np.cumsum(one) - one
        out[np.concatenate([np.arange(at[k], at[k] + one[k]) for k in odd.tolist()])] = np.concatenate(spelt)
        return out, np.repeat(word, one)

    def _rounds_short(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rounds in which each word merges the leftmost of its best pairs."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank, make = np.full(len(sym), NONE, dtype=np.int32), np.zeros(len(sym), dtype=np.int64)
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner], make[inner] = self.pairs.of(sym[inner], sym[inner + 1])
        while len(sym):
            start = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            size = np.diff(np.append(start, len(word)))
            low = np.minimum.reduceat(rank, start)
            if np.any(low == NONE):
                over = np.repeat(low == NONE, size)
                done.append((sym[over], word[over]))
                sym, word, rank, make = sym[~over], word[~over], rank[~over], make[~over]
                size, low = size[low < NONE], low[low < NONE]
                if not len(sym):
                    break
            best = np.flatnonzero(rank == np.repeat(low, size))
            of = word[best]
            at = best[np.concatenate(([True], of[1:] != of[:-1]))]
            sym, word, rank, make = self._merge(at, sym, word, rank, make)
        if not done:
            return sym, word
        sym, word = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        return sym[order], word[order]

    def _merge(self, at, sym, word, rank, make):
        """Merge the pairs at these places, no two of which share a symbol, and compact."""
        sym[at] = make[at]
        keep = np.ones(len(sym), dtype=bool)
        keep[at + 1] = False
        sym, word, rank, make = sym[keep], word[keep], rank[keep], make[keep]
        at = at - np.arange(len(at))
        stale = np.unique(np.concatenate((at, at[at > 0] - 1)))
        rank[stale], make[stale] = NONE, 0
        stale = stale[stale + 1 < len(sym)]
        stale = stale[word[stale] == word[stale + 1]]
        rank[stale], make[stale] = self.pairs.of(sym[stale], sym[stale + 1])
        return sym, word, rank, make

    def _rounds_long(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rounds in which each pair merges that is best within the model's reach.

        Words stand apart by a reach of empty symbols. Of equal pairs in reach of one
        another those from the left go at once, each second one where they overlap,
        up to the first that can go on at the same rank or a better one.
        """
        reach = self.reach + 1
        n_words = int(word[-1]) + 1
        first = np.searchsorted(word, np.arange(n_words))
        place = np.arange(len(sym)) + reach * (word + 1)
        wide = np.full(len(sym) + reach * (n_words + 1), -1, dtype=np.int64)
        of = np.repeat(np.arange(n_words + 1), np.append(np.diff(np.append(first, len(sym))) + reach, reach))
        wide[place] = sym
        sym, word = wide, of  # an empty symbol is -1 and pairs with nothing
        rank, make = np.full(len(sym), NONE, dtype=np.int32), np.zeros(len(sym), dtype=np.int64)
        rank[:-1], make[:-1] = self.pairs.of(sym[:-1], sym[1:])
        while True:
            ok = (rank < NONE) & (rank == _window_min(rank, reach, both=True))
            at = np.flatnonzero(ok)
            if not len(at):
                break
            at = at[self._go(at, ok, rank, make, sym, reach)]
            sym, word, rank, make = self._merge(at, sym, word, rank, make)
        keep = sym != -1
        return sym[keep], word[keep]

    def _go(self, at, ok, rank, make, sym, reach) -> np.ndarray:
        """Which of the best pairs at these places can merge in one round."""
        place = np.arange(len(rank))
        run = np.maximum.accumulate(np.where(np.append(True, rank[1:] != rank[:-1]), place, 0))
        turn = ok & ((place - run) % 2 == 0)
        mine = np.flatnonzero(turn)
        if not len(mine):
            return turn[at]
        made, r = make[mine], rank[mine]
        on = np.minimum(self.pairs.of(sym[mine - 1], made)[0], self.pairs.of(made, sym[mine + 2])[0])
        for near in (mine - 2, mine + 2):
            twin = np.where(turn[near], make[near], -1)
            pair = (twin, made) if near[0] < mine[0] else (made, twin)
            on = np.minimum(on, self.pairs.of(*pair)[0])
        stops = (rank < NONE) & ~ok
        stops[mine[on <= r]] = True
        before = np.full(len(rank), NONE, dtype=np.int32)
        before[1:] = _window_min(np.where(stops, rank, NONE), reach, both=False)[:-1]
        hit = np.cumsum(before[at] == rank[at])
        chain = np.concatenate(([True], np.diff(at) > reach))
        base = np.maximum.accumulate(np.where(chain, np.concatenate(([0], hit[:-1])), 0))
        return turn[at] & (hit == base)

    # decoding

    def _decoding(self, p, names: list[str]) -> None:
        surface = []
        for k, name in enumerate(names):
            if p.is_control(k):
                surface.append(b"")
            elif p.is_unknown(k):
                surface.append(p.decode([k]).encode())
            elif p.is_byte(k):
                surface.append(bytes([int(name[3:5], 16)]))
            else:
                surface.append(name.replace(SPACE, " ").encode())
        self.surface = np.frombuffer(b"".join(surface), dtype=np.uint8)
        self.wide = np.array([len(s) for s in surface], dtype=np.int64)
        self.at = np.cumsum(self.wide) - self.wide
        self.is_byte = np.zeros(self.size, dtype=bool)
        self.is_byte[self.bytes] = True
        self.silent = np.array([p.is_control(k) for k in range(self.size)])
        self.led = np.array([s[:1] == b" " and not p.is_unknown(k) and not p.is_byte(k) for k, s in enumerate(surface)])

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """The texts of ids laid end to end, sizes[k] of them for text k.

        The space that encoding puts before a text goes; a byte that is no part
        of a UTF-8 character becomes U+FFFD. An id outside the model is an error.
        """
        ids = ids.astype(np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= self.size):
            raise ValueError("an id is outside the model")
        cum = np.concatenate(([0], np.cumsum(sizes)))
        speaks = np.flatnonzero(~self.silent[ids])
        first = np.searchsorted(speaks, cum[:-1])
        first = np.where(first < len(speaks), speaks[np.minimum(first, len(speaks) - 1)], len(ids)) if len(speaks) else np.full(len(sizes), len(ids))
        first = first[first < cum[1:]]
        width, begin = self.wide[ids], self.at[ids]
        cut = first[self.led[ids[first]]]
        width[cut] -= 1
        begin[cut] += 1
        to = np.concatenate(([0], np.cumsum(width)))
        raw = self.surface[np.repeat(begin - to[:-1], width) + np.arange(to[-1])].tobytes()
        edge = to[cum].tolist()
        apart = self.silent[ids] & (np.concatenate(([False], self.is_byte[ids[:-1]])) if len(ids) else False)  # bytes on its two sides are no character
        torn = np.concatenate(([0], np.cumsum(apart)))[cum]
        torn = np.diff(torn) > 0
        out = []
        for k, (a, b) in enumerate(zip(edge[:-1], edge[1:])):
            mine = slice(cum[k], cum[k + 1])
            try:
                out.append(self._mended(ids[mine], raw[a:b], width[mine]) if torn[k] else raw[a:b].decode())
            except UnicodeDecodeError:
                out.append(self._mended(ids[mine], raw[a:b], width[mine]))
        return out

    def _mended(self, ids: np.ndarray, raw: bytes, width: np.ndarray) -> str:
        """A text with runs of bytes that are not whole characters."""
        out, at = [], 0
        kind = self.is_byte[ids] + 2 * self.silent[ids].astype(np.int8)
        edges = np.flatnonzero(np.diff(kind)) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(ids)]):
            part = raw[at : at + int(width[a:b].sum())]
            at += len(part)
            out.append(_each(part) if kind[a] == 1 else part.decode())
        return "".join(out)


def _each(raw: bytes) -> str:
    """UTF-8 where it holds; each byte that starts no character is U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


def _window_min(x: np.ndarray, reach: int, both: bool) -> np.ndarray:
    """The least value among each place, the ``reach`` places before it and, if both, those behind it."""
    out, have = x, 1
    while have < reach + 1:
        step = min(have, reach + 1 - have)
        new = out.copy()
        new[step:] = np.minimum(new[step:], out[:-step])
        out, have = new, have + step
    if not both:
        return out
    ahead = np.full_like(x, NONE)
    ahead[:-reach] = out[reach:]  # the last places are empty symbols
    return np.minimum(out, ahead)


def _pieces(text: str) -> list[str]:
    """A text cut between words into parts of about CHUNK characters."""
    out, at = [], 0
    while len(text) - at > CHUNK:
        m = _BETWEEN.search(text, at + CHUNK)
        if m is None:
            break
        out.append(text[at : m.end()])
        at = m.end()
    out.append(text[at:] if at else text)
    return out


@lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    """One coder a worker process."""
    return Coder(path)


def encode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids) of each row, no shuffle; ``ids`` is array<int>.

    A null text is empty and has no ids. Rows with equal or null keys are rows of
    their own. Other columns are neither read nor returned, whatever their names.
    """
    workers_import_this(docs.sparkSession)

    def run(batches):
        c = coder(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = c.encode(part.column(1).to_pylist())
                edge = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32))
                flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, dtype=np.int32), pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(edge, flat)], names=["key", "ids"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField("key", rows.schema["key"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def decode(coded: DataFrame, model: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, ids, text) of each row of ids, no shuffle. Null ids are none, their text is empty; null elements are an error."""
    workers_import_this(coded.sparkSession)

    def run(batches):
        c = coder(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = part.column(1)
                sizes = np.array(lists.value_lengths().fill_null(0))
                texts = c.decode(np.array(lists.flatten(), dtype=np.int64), sizes)
                yield pa.RecordBatch.from_arrays([part.column(0), lists, pa.array(texts, pa.string())], names=["key", "ids", "text"])

    rows = coded.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    schema = T.StructType([*rows.schema.fields, T.StructField("text", T.StringType())])
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def op12(docs: DataFrame, model: str) -> DataFrame:
    """The digest columns of the query, from the ids and the decoded texts."""
    out = decode(encode(docs, model), model)
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.encode(listed, "UTF-8"), 256).alias("ids_sha256"), F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"),
    )
