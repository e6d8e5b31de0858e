"""The pipeline's near copies come through SimHash first."""

import random

import numpy as np

import corpus_pipeline as pipeline
from deliverylens.llm import near_dup, simhash


def test_the_stage_links_fingerprints(spark, monkeypatch):
    asked, plain = [], simhash.links
    monkeypatch.setattr(simhash, "links", lambda fps, bits=2, *more: asked.append((set(fps.columns) >= {"fp"}, bits)) or plain(fps, bits, *more))
    words = [f"w{k}" for k in range(400)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:200], "x", *words[201:]])), (3, " ".join(words[:200])), (4, None), (5, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in pipeline.near_copies(spark, docs, "").collect()} == {1, 3, 4}
    assert asked == [(True, near_dup.MAX_BITS)]


def test_sets_are_proposed_by_their_fingerprints(spark):
    r = random.Random(3)
    base = [r.getrandbits(64) for _ in range(30)]
    fps = [x ^ sum(1 << b for b in r.sample(range(64), r.choice([0, 1, 2, 3, 5]))) for x in base for _ in range(6)]
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    got = {(x.a, x.b) for x in near_dup.by_fingerprint(spark.createDataFrame(list(enumerate(signed)), "u long, fp long")).collect()}
    near = {(a, b) for b in range(len(fps)) for a in range(b) if (fps[a] ^ fps[b]).bit_count() <= near_dup.MAX_BITS}
    assert got <= near and {x for p in got for x in p} == {x for p in near for x in p}
    stored = {tuple(sorted((u, v))) for u, v in got}
    assert stored == got and len(got) <= 2 * len(fps)


def test_fingerprints_are_those_of_the_operator(spark):
    texts = ["a b c d e f g", "A b C d e F g", None, "", "one", " ".join(f"v{k % 9}" for k in range(50))]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r.id: r.fp for r in near_dup.keyed(docs, 0.8).collect()}
    want = {r.id: r.fp for r in simhash.fingerprints(docs, near_dup.SHINGLE, "id", "text").collect()}
    assert got == want
