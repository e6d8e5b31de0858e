"""Conversation repair, SentencePiece coding and fill-in-the-middle against brute force, the library, and on odd rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from deliverylens.llm import conversations, fill_middle, sentence_pieces
from deliverylens.llm.tokens import vocabulary

# ---- 11

SPACE = " \t\n\x0b\x0c\r"
TURNS = "conv_id long, turn long, role string, text string"


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        draw = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if draw == 1:
            text = ""
        if draw == 2:
            text = text.replace(".", "").replace("!", "").replace("?", "")
        if draw == 4:
            role = "user"
        out += [(c, t, role, text)] * {0: 0, 3: 2}.get(draw, 1)
    return out


def repaired(rows):
    """One conversation, forward over its rows with whole audits in each state."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    turns = [r[1] for r in rows if r[1] is not None]
    count = {"blank": 0, "duplicate": 0, "truncated": 0}
    best = {"": (0, "", ())}
    seen = set()

    def insert(best):
        for _ in range(3):
            for q, (cost, audit, said) in list(best.items()):
                to = "a" if q == "u" else "u"
                new = (cost + 5, audit + "I", said + (({"u": "user", "a": "assistant"}[to], ""),))
                if to not in best or new[:2] < best[to][:2]:
                    best[to] = new
        return best

    for _, _, role, text in rows:
        bare = text.rstrip(SPACE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            count[fault] += 1
        new = {}
        for q, (cost, audit, said) in insert(best).items():
            ways = [(q, cost + 2, audit + "D", said)]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault else 0
                to = role[:1]
                if (q, to) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}:
                    ways.append((to, cost + more, audit + "K", said + ((role, text),)))
                to = "a" if q == "u" else "u"
                ways.append((to, cost + more + 1, audit + "R", said + (({"u": "user", "a": "assistant"}[to], text),)))
            for to, cost_, audit_, said_ in ways:
                if to not in new or (cost_, audit_) < new[to][:2]:
                    new[to] = (cost_, audit_, said_)
        best = new
    ends = [v for q, v in insert(best).items() if q in ("", "a")] if rows else [(0, "", ())]
    cost, audit, said = min(ends, key=lambda v: v[:2])
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    text = "\n".join(f"{r}:{t}" for r, t in said)
    return (gaps, *count.values(), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def chats(seed, n):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        said = ["Yes.", "No!", "Is it?", "well", "", " \t", "the end. ", "Ünï — “x”."]
        for t in range(r.choice([0, 1, 2, 3, 5, 9, 14])):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            turn = None if t == 0 and r.random() < 0.1 else t + r.choice([0, 0, 0, 20])
            rows.append((c, turn, role, r.choice([*said, None, f"Say {r.randrange(99)}."])))
    return rows


def by_conversation(rows, all_rows):
    groups = {c: [] for c, *_ in all_rows}
    for row in rows:
        groups[row[0]].append(row)
    return groups


@pytest.mark.parametrize("bits", [12, 1])
def test_repair_equals_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(conversations, "BLOCK_BITS", bits)
    rows = chats(5, 300) + [(None, 1, "user", "Hi."), (None, 2, "assistant", "Hello."), (None, 2, "assistant", "Hello.")]
    got = {r[0]: tuple(r)[1:] for r in conversations.op11(spark.createDataFrame(rows, TURNS).repartition(5)).collect()}
    want = {c: repaired(mine) for c, mine in by_conversation(damaged(rows), rows).items()}
    assert got == want


def test_repaired_turns_are_whole(spark):
    rows = chats(7, 120)
    found = conversations.repair(spark.createDataFrame(rows, TURNS))
    turns = defaultdict(list)
    for r in found.turns.orderBy("conv_id", "number", "k").collect():
        turns[r.conv_id].append((r.role, r.text))
    for c, mine in by_conversation([(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows], rows).items():
        text = "\n".join(f"{r}:{t}" for r, t in turns[c])
        assert hashlib.sha256(text.encode()).hexdigest() == repaired(mine)[-1]
        roles = "".join(r[:1] for r, _ in turns[c])
        assert roles.removeprefix("s").replace("ua", "") == "" and roles != "s"


def test_long_conversation_goes_in_blocks(spark):
    r = random.Random(3)
    rows = [(1, t, r.choice(["user", "assistant"]), f"Say {t}{r.choice('.!,')}") for t in range(9_000)] + [(2, 0, "user", "Hi."), (2, 1, "assistant", "Oh.")]
    got = {x[0]: tuple(x)[1:] for x in conversations.op11(spark.createDataFrame(rows, TURNS).repartition(4)).collect()}
    assert len(conversations._blocks(conversations._placed(spark.createDataFrame(rows, TURNS), "conv_id", "turn", "role", "text")).select("signature").collect()) > 3
    assert got[2] == repaired(damaged(rows[9_000:]))
    summary = {n: v for n, v in zip(("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "sha"), got[1])}
    mine = sorted(damaged(rows[:9_000]), key=lambda x: x[1])
    costs = {"": 0}  # costs alone, as whole audits of 9,000 rows in each state would be slow
    seen = set()
    for _, _, role, text in mine:
        bare = text.rstrip(SPACE)
        gone = not bare or (role, text) in seen
        more = 5 if bare and bare[-1] not in ".!?" else 0
        seen.add((role, text))
        for _ in range(3):
            for q, c in list(costs.items()):
                to = "a" if q == "u" else "u"
                costs[to] = min(costs.get(to, 10**9), c + 5)
        new = {q: c + 2 for q, c in costs.items()}
        for q, c in costs.items() if not gone else ():
            to = "a" if q == "u" else "u"
            new[to] = min(new.get(to, 10**9), c + more + (0 if role[0] == to else 1))
            if q == "a" and role[0] == "u":
                new["u"] = min(new.get("u", 10**9), c + more)
        costs = new
    assert summary["cost"] == min(costs.get("", 10**9), costs.get("a", 10**9), costs.get("u", 10**9) + 5)
    assert len(summary["audit"].replace("I", "")) == len(mine)


def test_repair_of_nothing_and_clashing_columns(spark):
    none = spark.createDataFrame([], TURNS)
    assert conversations.op11(none).collect() == []
    rows = [(3, 0, "user", "Hi.", "x", 1, "y"), (3, 1, "assistant", "Ho.", "x", 1, "y")]
    odd = spark.createDataFrame(rows, TURNS + ", conv string, number long, h string")
    assert [tuple(r)[1:8] for r in conversations.op11(odd).collect()] == [repaired(damaged([r[:4] for r in rows]))[:7]]


# ---- 12


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def coder():
    return sentence_pieces.Coder(vocabulary("piece_bpe_32k.model"))


def texts(seed, n, library):
    r = random.Random(seed)
    names = [library.id_to_piece(k).replace("▁", " ") for k in range(259, 32_000)]
    odd = ["a", "b", " ", "  ", "▁", "\n", "\t", "é", "ﬁ", "　", "日", "本", "🤦", "\x00", "the", "ing", "=", "-", "aab", "aba", "0"]
    for k in range(n):
        yield (
            "".join(r.choice(odd) for _ in range(r.randrange(60))),
            "".join(r.choice(names) for _ in range(r.randrange(60))),
            r.choice(["a", "=", "ab", "the", "-", " ", "▁ ", "er", "aaaab", "issi", "00"]) * r.randrange(150) + r.choice(["", "x", " t"]),
            "".join(r.choice("aeinstABC019+/") for _ in range(r.randrange(300))),
            "".join(r.choice(["ab", "ba", " " * r.randrange(1, 40), "x"]) for _ in range(r.randrange(60))),
        )[k % 5]


@pytest.mark.parametrize("short", [64, 4])
def test_merge_rounds_equal_the_library(coder, library, monkeypatch, short):
    monkeypatch.setattr(sentence_pieces, "SHORT", short)
    coder.table.clear()
    mine = [*texts(short, 1_500, library), "", None, " "]
    got = coder.encode(mine)
    want = library.encode([t or "" for t in mine])
    assert [g.tolist() for g in got] == want
    assert coder.decode(np.concatenate(got), np.array([len(g) for g in got])) == [library.decode(w) for w in want]


def test_very_long_texts_and_words(coder, library):
    r = random.Random(8)
    for text in ("a" * 60_000, " " * 60_000, "ab" * 40_000, "".join(r.choice("abcdefXYZ0189+/") for _ in range(60_000)), "one two  three. " * 60_000, "日本" * 30_000, "é" * 20_000):
        assert coder.encode([text])[0].tolist() == library.encode(text)


def test_chunks_and_a_full_table_change_nothing(coder, library, monkeypatch):
    monkeypatch.setattr(sentence_pieces, "CHUNK", 50)
    monkeypatch.setattr(sentence_pieces, "MAX_WORDS", 40)
    coder.table.clear()
    mine = list(texts(2, 200, library))
    assert [g.tolist() for g in coder.encode(mine)] == library.encode(mine)
    coder.table.clear()


def test_any_ids_decode_as_the_library_does(coder, library):
    r = random.Random(4)
    ids = [[r.choice([0, 1, 2, r.randrange(3, 259), r.randrange(3, 259), r.randrange(259, 32_000), 28_705, 259]) for _ in range(r.randrange(9))] for _ in range(5_000)]
    assert coder.decode(np.array([k for x in ids for k in x]), np.array([len(x) for x in ids])) == [library.decode(x) for x in ids]
    with pytest.raises(ValueError):
        coder.decode(np.array([32_000]), np.array([1]))


def test_coding_rows(spark, library):
    rows = [(1, "one  two\nthree"), (1, "one"), (None, "x"), (2, None), (3, ""), (4, "🤦 ﬁ")]
    docs = spark.createDataFrame([(k, t, "i", 7) for k, t in rows], "doc_id long, text string, ids string, key int")
    model = vocabulary("piece_bpe_32k.model")
    coded = sentence_pieces.encode(docs, model)
    assert sorted(((r[0] or 0, tuple(r[1])) for r in coded.collect())) == sorted((k or 0, tuple(library.encode(t or ""))) for k, t in rows)
    out = sentence_pieces.op12(docs, model)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = [(k or 0, len(i := library.encode(t or "")), sha(",".join(map(str, i))), sha(library.decode(i))) for k, t in rows]
    assert sorted((r[0] or 0, *tuple(r)[1:]) for r in out.collect()) == sorted(want)
    assert sentence_pieces.op12(docs.limit(0), model).collect() == []
    assert [tuple(r) for r in sentence_pieces.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), model).collect()] == [(1, None, "")]


# ---- 13

MIDDLES = ["", None, "a", "ab", "Ünï çödé — “x” 🤦🏼‍♂️ y", "line one\nline two\n\nfour", "has <P> inside", "<M>", "<S", "x <", "P> <<", " lead", "  two  \t spaces ", "é" * 5, "na " * 30_000]


def plain_cut(unit, text):
    """The units of a text, as Python says them."""
    import re

    if unit == "char":
        return list(text)
    if unit == "line":
        return text.splitlines(keepends=True) if "\r" not in text else re.findall(r"[^\n]*\n|[^\n]+", text)
    return re.findall(r"^[ \t\n\x0b\x0c\r]+|[^ \t\n\x0b\x0c\r]+[ \t\n\x0b\x0c\r]*", text)


@pytest.mark.parametrize("unit", ["char", "word", "line"])
def test_fill_in_middle_equals_brute_force(spark, unit):
    rows = [(k, MIDDLES[k % len(MIDDLES)]) for k in range(120)] + [(5, "a row of the same key"), (None, "no key")]
    docs = spark.createDataFrame([(k, t, "n", 3) for k, t in rows], "doc_id long, text string, form string, h1 int").repartition(3)
    out = fill_middle.restore(fill_middle.fill_in_middle(docs, unit=unit, seed=1))
    got = sorted((-1 if r[0] is None else r[0], *tuple(r)[1:]) for r in out.collect())
    want = []
    for k, text in rows:
        text = text or ""
        h = hashlib.sha256(f"1:{'' if k is None else k}".encode()).hexdigest()
        h = [int(h[8 * j : 8 * j + 8], 16) for j in range(4)]
        parts = plain_cut(unit, text)
        n = len(parts)
        a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        form = "plain" if not text or any(s in text for s in fill_middle.SENTINELS) or h[2] % 100 >= 90 else "spm" if h[3] % 100 < 20 else "psm"
        pre, mid, suf = "".join(parts[:a]), "".join(parts[a:b]), "".join(parts[b:])
        made = {"plain": text, "psm": f"<P>{pre}<S>{suf}<M>{mid}", "spm": f"<S>{suf}<P>{pre}<M>{mid}"}[form]
        want.append((-1 if k is None else k, n, form, None if form == "plain" else a, None if form == "plain" else b - a, made, text))
    assert got == sorted(want, key=lambda r: (r[0], r[1]))


def test_fill_in_middle_equals_sql(spark, tmp_path):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(MIDDLES * 4)], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = fill_middle.op13(docs)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = db.execute(fill_middle.ORACLE_SQL)
    assert [c[0] for c in want.description] == got.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
    assert fill_middle.op13(docs.limit(0)).collect() == []


def test_cuts_do_not_depend_on_the_batch():
    r = random.Random(2)
    mine = [t or "" for t in MIDDLES[:-1]] * 3
    draws = np.array([[r.randrange(2**32) for _ in range(4)] for _ in mine], dtype=np.int64)
    whole = fill_middle.cut(pa.array(mine), draws, "char", 90, 20, fill_middle.SENTINELS)
    for k, text in enumerate(mine):
        one = fill_middle.cut(pa.array(["pad", text])[1:], draws[k : k + 1], "char", 90, 20, fill_middle.SENTINELS)
        assert one.to_pylist() == whole.slice(k, 1).to_pylist()


def test_sentinels_that_overlap_are_refused(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    for bad in (("<P>", "<P>", "<M>"), ("", "b", "c"), ("ab", "bc", "d"), ("aa", "b", "c"), ("a", "xax", "c")):
        with pytest.raises(ValueError):
            fill_middle.fill_in_middle(docs, sentinels=bad)
    with pytest.raises(Exception, match="lacks a sentinel"):
        fill_middle.restore(spark.createDataFrame([("psm", "<P>a<M>b")], "form string, output string")).collect()
