"""Token ids of whole texts, with a bounded table of word encodings.

Both kinds of vocabulary split a text at white space before they merge, so the
ids of a text are those of its words put together. Words come back again and
again: a batch of texts is cut into words and looked up in a hash table with
numpy by a 64-bit hash of its bytes (two different words share one with a chance
of about 2**-64), and only words that are not in it go to the tokenizer. Texts for which
that split isn't plainly safe, such as those that hold an added token, go to the
tokenizer whole.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np

from . import words as W

#: Entries that a worker's table holds before it starts anew.
MAX_WORDS = 2_000_000
BATCH_CHARS = 200_000
_TEXT_WORDS = 400
#: Marks that may follow a word's letters; apostrophes bind letters and are left out.
TAIL = ",.!?;:|*$#%&()[]{}<>=+-/\\\"_@^`"
_AFTER_FEED = np.uint64(0xA5A5F00DC0FFEE11)
_CONTROL = np.zeros(256, dtype=bool)
_CONTROL[[*range(0, 10), *range(11, 32), 127]] = True
_FAR_SPACE = re.compile("[\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")


class _Table:
    """Word hash -> ids, open addressing in arrays."""

    def __init__(self):
        self.mask = np.uint64((1 << (2 * MAX_WORDS - 1).bit_length()) - 1)
        self.clear()

    def clear(self) -> None:
        n = int(self.mask) + 1
        self.keys, self.entry = np.zeros(n, dtype=np.uint64), np.zeros(n, dtype=np.int32)
        self.start, self.size = np.zeros(1 << 16, dtype=np.int64), np.zeros(1 << 16, dtype=np.int64)
        self.ids, self.n_ids, self.n = np.zeros(1 << 18, dtype="<u4"), 0, 0

    def find(self, h: np.ndarray) -> np.ndarray:
        """The entries of hashes, -1 where there is none."""
        at = h & self.mask
        key = self.keys[at]
        out = np.where(key == h, self.entry[at], np.int32(-1))
        left = np.flatnonzero((key != h) & (key != 0))
        while len(left):
            at[left] = (at[left] + np.uint64(1)) & self.mask
            key = self.keys[at[left]]
            hit = key == h[left]
            out[left[hit]] = self.entry[at[left[hit]]]
            left = left[~hit & (key != 0)]
        return out

    def add(self, h: np.ndarray, ids: list[np.ndarray]) -> None:
        """New entries for hashes that the table doesn't have, all different."""
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        total, entry = int(sizes.sum()), np.arange(self.n, self.n + len(ids), dtype=np.int32)
        while self.n + len(ids) > len(self.start):
            self.start, self.size = np.resize(self.start, 2 * len(self.start)), np.resize(self.size, 2 * len(self.size))
        while self.n_ids + total > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.start[entry] = self.n_ids + np.cumsum(sizes) - sizes
        self.size[entry] = sizes
        if total:
            self.ids[self.n_ids : self.n_ids + total] = np.concatenate(ids)
        self.n, self.n_ids = self.n + len(ids), self.n_ids + total
        at, left = h & self.mask, np.arange(len(h))
        while len(left):
            free = left[self.keys[at[left]] == 0]
            self.keys[at[free]] = h[free]
            won = self.keys[at[left]] == h[left]
            self.entry[at[left[won]]] = entry[left[won]]
            left = left[~won]
            at[left] = (at[left] + np.uint64(1)) & self.mask

    def of(self, entry: int) -> np.ndarray:
        return self.ids[self.start[entry] : self.start[entry] + self.size[entry]]


class WordEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids, as bytes.

    byte_level: a space belongs to the word after it and a line feed is a token
    of its own; otherwise white space is dropped. Give the kind of the file.
    """

    def __init__(self, path: str, byte_level: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: Added tokens, such as an end of text, get their own ids wherever a text holds them.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.byte_level = byte_level
        (self.mark,) = self._whole(["\n" if byte_level else "~"])[0]
        self.table = _Table()
        self.tails: dict[str, np.ndarray] = {}

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain(self, text: str) -> bool:
        """Whether the ids of this text are those of its words put together."""
        return self._plain_bytes(np.frombuffer(text.encode(), dtype=np.uint8), text)

    def _plain_bytes(self, buf: np.ndarray, text: str) -> bool:
        if any(t in text for t in self.added):
            return False
        space = W.IS_SPACE[buf]
        if self.byte_level and len(buf) and (space[0] or space[-1] or np.any(space[1:] & space[:-1])):
            return False
        if np.any(_CONTROL[buf]) or (not self.byte_level and np.any(buf == 126)):
            return False
        return not (np.any((buf == 0xC2) | ((buf >= 0xE1) & (buf <= 0xE3))) and _FAR_SPACE.search(text))

    def encode(self, text: str | None) -> bytes:
        """The ids of one whole text; none for null or empty."""
        return self.encode_many([text])[0]

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text."""
        out = [b""] * len(texts)
        part, chars = [], 0
        for k, text in enumerate(texts):
            if text:
                part.append(k)
                chars += len(text)
                if chars >= BATCH_CHARS:
                    self._batch(part, texts, out)
                    part, chars = [], 0
        self._batch(part, texts, out)
        return out

    def _batch(self, part: list[int], texts: list, out: list[bytes]) -> None:
        if not part:
            return
        joined = "\n".join([texts[k] for k in part])
        raw = joined.encode()
        if not self._plain_bytes(np.frombuffer(raw, dtype=np.uint8), joined):
            odd = [k for k in part if not self._plain(texts[k])]
            for k, ids in zip(odd, self._whole([texts[k] for k in odd])):
                out[k] = ids.tobytes()
            part = [k for k in part if k not in set(odd)]
            if not part:
                return
            raw = "\n".join([texts[k] for k in part]).encode()
        raw = b"\n" + raw
        sizes = [len(texts[k]) if texts[k].isascii() else len(texts[k].encode()) for k in part]
        begins = np.cumsum([1, *[s + 1 for s in sizes]])
        ids, ends = self._words(raw)
        first = np.searchsorted(ends[1], begins)
        cum = ends[0]
        skip = 1 if self.byte_level else 0  # the line feed before a text isn't the text's
        for j, k in enumerate(part):
            a, b = first[j], first[j + 1]
            if b > a:
                out[k] = ids[cum[a] + skip : cum[b]].tobytes()

    def _words(self, raw: bytes) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
        """The ids of all words of a buffer, (where each word's begin, the words' starts)."""
        buf = np.frombuffer(raw, dtype=np.uint8)
        starts, ends = W.spans(buf)
        h = self._keys(W.word_hashes(buf, starts, ends), buf[starts - 1] == 10 if len(starts) else None)
        entry = self.table.find(h)
        new = np.flatnonzero(entry < 0)
        if len(new):
            if self.table.n + 2 * len(new) > MAX_WORDS:
                self.table.clear()
                new = np.arange(len(h))
            _, one = np.unique(h[new], return_index=True)
            one = new[one]
            s, e = (starts[one] - 1, ends[one]) if self.byte_level else (starts[one], ends[one])
            self._learn([raw[a:b].decode() for a, b in zip(s.tolist(), e.tolist())], h[one])
            entry = self.table.find(h)
        size = self.table.size[entry]
        cum = np.concatenate(([0], np.cumsum(size)))
        return self.table.ids[np.repeat(self.table.start[entry] - cum[:-1], size) + np.arange(cum[-1])], (cum, starts)

    def _keys(self, h: np.ndarray, feed: np.ndarray | None) -> np.ndarray:
        if self.byte_level and feed is not None:
            h = np.where(feed, W.mix(h ^ _AFTER_FEED), h)
        return np.where(h == 0, np.uint64(1), h)

    def _learn(self, words: list[str], keys: np.ndarray) -> None:
        """Put new words, with their space or line feed before them, into the table.

        Punctuation after an ASCII letter is a token run of its own in both
        vocabularies, so such a word is put together from its parts. Other
        letters may lower-case to a letter and a mark, which joins what follows.
        """
        at = 1 if self.byte_level else 0
        stems, tails = [], []
        for w in words:
            stem = w.rstrip(TAIL)
            if len(stem) == len(w) or not stem[at:].isalpha() or not stem[-1].isascii():
                stem = w
            stems.append(stem)
            tails.append(w[len(stem) :])
        mine = dict(zip(words, keys.tolist()))
        alone = list(dict.fromkeys(stems))
        raw = "".join(alone if self.byte_level else [" " + w for w in alone]).encode()
        buf = np.frombuffer(raw, dtype=np.uint8)
        s, e = W.spans(buf)
        h = self._keys(W.word_hashes(buf, s, e), buf[s - 1] == 10)
        entry = self.table.find(h)
        new = np.flatnonzero(entry < 0).tolist()
        if new:
            self.table.add(h[new], self._encode([alone[k] for k in new]))
            entry = self.table.find(h)
        known = dict(zip(alone, entry.tolist()))
        rest, ids = [], []
        for w, stem, tail in zip(words, stems, tails):
            if tail:
                end = self.tails.get(tail)
                if end is None:
                    if len(self.tails) > 100_000:
                        self.tails.clear()
                    end = self.tails[tail] = self._whole([tail])[0]
                rest.append(mine[w])
                ids.append(np.concatenate((self.table.of(known[stem]), end)))
        if rest:
            self.table.add(np.array(rest, dtype=np.uint64), ids)

    def _encode(self, words: list[str]) -> list[np.ndarray]:
        """Ids of words, many to a text: a mark of one token stands before each."""
        parts = [words[at : at + _TEXT_WORDS] for at in range(0, len(words), _TEXT_WORDS)]
        if self.byte_level:  # a line feed begins each word: its mark, or its own first token
            texts = ["".join([w if w[0] == "\n" else "\n" + w for w in part]) for part in parts]
        else:
            texts = ["".join([" ~ " + w for w in part]) for part in parts]
        out: list[np.ndarray] = []
        for part, ids in zip(parts, self._whole(texts)):
            cut = np.flatnonzero(ids == self.mark)
            if len(cut) != len(part):
                out += self._whole(part)
                continue
            for w, a, b in zip(part, cut.tolist(), [*cut[1:].tolist(), len(ids)]):
                out.append(ids[a + (w[0] != "\n") : b])
        return out


def encoded(batches, coder: WordEncoder, rows: int = 256):
    """(id, ids as bytes) of each row of Arrow batches (id, text, ...)."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield from zip(part.column(0).to_pylist(), coder.encode_many(part.column(1).to_pylist()))


@lru_cache(maxsize=4)
def encoder(path: str, byte_level: bool) -> WordEncoder:
    """One encoder a worker process."""
    return WordEncoder(path, byte_level)


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file, looked up where it is used."""
    import public_tokenizers

    return public_tokenizers.path(name)
