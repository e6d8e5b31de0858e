"""Rows that share an id, have none, or repeat: nothing crashes and no clean word is lost."""

import hashlib
import random

import pytest

import corpus_pipeline
from deliverylens.llm import decontaminate, line_dedup, near_dup, packing, sentence_pieces, simhash, substring_rlz, token_store
from deliverylens.llm.tokens import vocabulary

R = random.Random(9)
WORDS = [f"w{k}" for k in range(400)]
LONG = " ".join(R.choice(WORDS) for _ in range(410))
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def line(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def test_substring_spans_go_to_the_rows_that_have_them(spark):
    clean = line(60, 1)
    rows = [(1, LONG), (1, "three short words"), (2, LONG), (2, clean), (3, "lead " + LONG), (3, "lead " + LONG), (None, LONG), (4, clean + " tail")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed, r.kept) for r in substring_rlz.factors(docs).collect())
    want = [(0, 410, 0, LONG), (1, 3, 0, "three short words"), (1, 410, 0, LONG), (2, 60, 0, clean), (2, 410, 410, ""), (3, 411, 410, "lead"), (3, 411, 410, "lead"), (4, 61, 60, "tail")]
    assert got == sorted(want)


def test_lines_go_from_the_rows_that_have_them(spark):
    lines = "q b c d".split()
    rows = [(1, "\n".join(lines)), (2, "a\nb\nc\nd\ne"), (2, "x\ny\nz1\nz2"), (2, "x\ny\nz1\nz2"), (None, "b\nc\nd")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.text, r.n_removed_lines) for r in line_dedup.dedup_lines(docs).collect())
    assert got == [(0, "b\nc\nd", 0), (1, "q\nb\nc\nd", 0), (2, "a\ne", 3), (2, "x\ny\nz1\nz2", 0), (2, "x\ny\nz1\nz2", 0)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("rows")
    spark.createDataFrame([("i1", line(30, 5)), ("i2", "yes"), ("i3", "What is it?")], "item_id string, text string").write.parquet(str(at / "benchmark.parquet"))
    return str(at)


def docs_of(spark, rows):
    return spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows], COLUMNS).repartition(3)


def kept(df):
    return sorted((r.doc_id or 0, r.text or "") for r in df.collect())


def test_near_copies_keep_unlike_namesakes(spark, folder):
    a, b = line(80, 2), line(80, 3)
    rows = [(1, a), (2, a), (2, b), (3, b + " more"), (None, a), (4, None), (5, "")]
    assert kept(corpus_pipeline.near_copies(spark, docs_of(spark, rows), folder)) == [(0, a), (1, a), (2, b), (4, "")]


def test_leaks_keep_clean_namesakes_and_short_items_flag_nothing(spark, folder):
    item, clean = line(30, 5), line(90, 6)
    rows = [(1, clean + " yes what is it"), (2, "before " + item + " after"), (2, clean), (None, item), (None, clean), (3, None)]
    for held in (decontaminate.HELD_GRAMS, 0):
        found = decontaminate.contaminated(docs_of(spark, rows), spark.read.parquet(f"{folder}/benchmark.parquet"), held_grams=held)
        assert {(r.doc_id, r.item_id) for r in found.collect()} == {(2, "i1"), (None, "i1")}
    assert kept(corpus_pipeline.leaks(spark, docs_of(spark, rows), folder)) == sorted([(1, clean + " yes what is it"), (2, clean), (0, clean), (3, "")])


def test_other_operators_take_rows_as_they_come(spark):
    rows = [(1, LONG), (1, "short"), (1, "short"), (None, "x"), (2, None)]
    docs = spark.createDataFrame([(k, t, "n", 1, "z") for k, t in rows], "doc_id long, text string, id string, offset int, ids string").repartition(2)
    got = simhash.groups(docs, shingle=3, max_bits=2)
    assert got.count() >= 4
    assert near_dup.groups(docs).count() == len(rows)
    model = vocabulary("piece_bpe_32k.model")
    assert sentence_pieces.op12(docs, model).count() == len(rows)
    store = token_store.round_trip(spark, docs.where("doc_id IS NOT NULL"), vocabulary("byte_bpe_50k.json"))
    assert store.count() == 4


@pytest.mark.parametrize("parts", [1, 64])
def test_packing_pads_nothing_however_small_the_partitions_are(spark, parts):
    rows = [(k, line(1 + k * 7 % 300, k)) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    pieces = packing.pack(docs, vocabulary("word_bpe_49k.json")).collect()
    size, held = {}, {}
    for p in pieces:
        size[p.sequence_id] = p.context
        held.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for sequence, spans in held.items():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at == size[sequence] and at & (at - 1) == 0
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append((p.start, p.length, p.doc_tokens))
    for spans in by_doc.values():
        at = 0
        for start, length, total in sorted(spans):
            assert start == at
            at += length
        assert at == total
    steps = {}
    for p in pieces:
        steps.setdefault(p.step_group, {})[p.sequence_id] = p.context
    assert all(sum(s.values()) <= 16_384 for s in steps.values())
    assert hashlib.sha256(str(sorted(by_doc)).encode()).hexdigest() and len(by_doc) == 200
