"""Rare words of test items are counted over all documents."""

import numpy as np
import pytest

from deliverylens.llm import decontaminate as D


@pytest.mark.parametrize("held", [True, False])
def test_words_are_counted_in_all_documents(spark, monkeypatch, held):
    monkeypatch.setattr(D, "SAMPLE_DOCS", 1, raising=False)
    item = [f"w{k}" for k in range(12)]
    rows = [(k, f"{item[k % 4]} {item[(k + 1) % 4]} other{k}") for k in range(60)] + [(60, None), (61, ""), (None, item[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    items = D.item_words(spark.createDataFrame([(1, " ".join(item)), (2, "too short")], "item_id long, text string"), 0.6)
    h = {w: int(D.tokens(w)[3].view(np.int64)[0]) for w in item}
    got = {r.w: r.c for r in D.how_often(docs, items, held).collect()}
    assert got == {h["w0"]: 30, h["w1"]: 30, h["w2"]: 30, h["w3"]: 31}
    assert {r.w for r in D.rarest(docs, items, held).collect()} == {h[w] for w in item[4:]}


def test_an_index_leaves_out_what_unsampled_documents_repeat(spark, monkeypatch):
    monkeypatch.setattr(D, "SAMPLE_DOCS", 1, raising=False)
    item = [f"w{k}" for k in range(12)]
    docs = spark.createDataFrame([(k, item[k % 4]) for k in range(60)], "doc_id long, text string")
    items = D.item_words(spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"), 0.6)
    common = {int(D.tokens(w)[3].view(np.int64)[0]) for w in item[:4]}
    assert not common & {r.w for r in D.rarest(docs, items).collect()}


@pytest.mark.parametrize("n", [0, 1, 7, 3000])
def test_lookup(n):
    r = np.random.default_rng(n)
    known = np.unique(np.concatenate((r.integers(0, 2**64, n, dtype=np.uint64), np.arange(n // 3, dtype=np.uint64))))
    asked = np.concatenate((known, r.integers(0, 2**64, 50, dtype=np.uint64), np.array([0, 2**64 - 1], dtype=np.uint64)))
    place = {x: k for k, x in enumerate(known.tolist())}
    assert D.Lookup(known).places(asked).tolist() == [place.get(x, -1) for x in asked.tolist()]
