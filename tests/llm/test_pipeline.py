"""The pipeline, stage by stage, against brute-force versions on a small corpus."""

import random
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline as pipeline
from deliverylens.llm import decontaminate, quality_rules, simhash
from tests.llm.test_operators import plain_alignment, plain_stats

COLUMNS = list(pipeline.COLUMNS)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with copies, leaks, junk, nulls and repeated lines; labels; test items."""
    r = random.Random(12)
    vocab = ["".join(r.choice("bcdfgklmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 3))) for _ in range(1500)]
    say = lambda n: [r.choice(vocab) for _ in range(n)]
    items = [(k, " ".join(say(25))) for k in range(6)]
    shared, rows, labels = [" ".join(say(8)) for _ in range(4)], [], []
    for i in range(240):
        lines = [" ".join(say(r.randint(5, 14))) for _ in range(r.randint(3, 8))]
        if i % 6 == 0:
            lines[1:1] = shared
        if i % 10 == 1:
            lines.append(items[i % 6][1])
        text = "\n".join(lines)
        if i % 8 == 3:
            text = " ".join(w + "$$$" for w in text.split())
        if i % 8 != 3 and i % 9 == 2 and rows:
            words = max((x[1] for x in rows[-3:] if x[1]), key=len).split(" ")
            words[len(words) // 2] = "edited"
            text = " ".join(words)
        rows.append((i, text, "en", f"src{i % 3}", len(text)))
        labels.append((i, 0 if i % 8 == 3 else 1, 0))
    rows += [(300, rows[5][1], "en", "a", 1), (301, None, "en", "a", 0), (302, "", None, None, None), (303, "few words", "en", "a", 9)]
    out = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return str(out)


def brute_quality(docs, rules):
    kept = []
    for d in docs:
        n, chars, symbols, dup, repeat = plain_stats(d[1])
        if n < 20 or 100 * repeat > 30 * n:
            continue
        x = {"symbols_per_word": symbols / max(n, 1)}
        if any(all(x[f] >= t if up else x[f] < t for f, up, t in rule.conditions) for rule in rules):
            continue
        kept.append(d)
    return kept


def brute_lines(docs):
    places = defaultdict(list)
    cut = {d[0]: d[1].split("\n") for d in docs}
    for i, lines in sorted(cut.items()):
        for k in range(len(lines) - 2):
            if "".join(lines[k : k + 3]).strip():
                places[tuple(lines[k : k + 3])].append((i, k))
    gone = defaultdict(set)
    for found in places.values():
        for i, k in sorted(found)[1:]:
            gone[i] |= {k, k + 1, k + 2}
    out = []
    for i, _, lang, source, n in docs:
        text = "\n".join(x for k, x in enumerate(cut[i]) if k not in gone[i])
        if text.strip() or not gone[i]:
            out.append((i, text, lang, source, len(text) if gone[i] else n))
    return out


def jaccard(a, b):
    x, y = (set(simhash.shingle_hashes(t, 5).tolist()) for t in (a, b))
    return len(x & y) / len(x | y)


def brute_leaks(docs, items):
    out = []
    for d in docs:
        words = decontaminate.tokens(d[1])[3]
        grams = {tuple(words[k : k + 4].tolist()) for k in range(len(words) - 3)}
        for item in items:
            one = decontaminate.tokens(item)[3]
            if grams & {tuple(one[k : k + 4].tolist()) for k in range(len(one) - 3)} and decontaminate.align(one, words)[1] >= decontaminate.MIN_SCORE * len(one):
                assert plain_alignment(one, words) == decontaminate.align(one, words)[0]
                break
        else:
            out.append(d)
    return out


def test_stages_equal_brute_force(spark, folder, tmp_path):
    key = lambda r: r[0]
    read = lambda df: sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=key)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    (_, rules) = quality_rules.judge(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    assert rules.rules and {f for x in rules.rules for f, _, _ in x.conditions} == {"symbols_per_word"}
    assert [n for n, _ in pipeline.STAGES] == ["quality rules", "line dedup", "near copies", "decontamination", "packing"]
    rows = read(docs)
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    for name, stage in pipeline.STAGES[:4]:
        got_df = stage(spark, docs, folder)
        assert got_df.columns == COLUMNS
        got = read(got_df)
        if name == "quality rules":
            want = sorted(brute_quality(rows, rules.rules), key=key)
            assert len(want) < 0.95 * len(rows)
        elif name == "line dedup":
            want = sorted(brute_lines(rows), key=key)
            assert want != rows
        elif name == "near copies":
            want, left = got, {r[0] for r in got}
            assert set(got) <= set(rows)
            for r in rows:  # what goes is near to a document with a smaller id; copies of the words go
                if r[0] not in left:
                    assert max(jaccard(r[1], q[1]) for q in rows if q[0] < r[0]) >= 0.65
            words = [tuple(r[1].split()) for r in got]
            assert len(set(words)) == len(words)
        else:
            want = sorted(brute_leaks(rows, items), key=key)
            assert len(want) < len(rows)
        assert got == want, name
        path = str(tmp_path / name)
        got_df.write.parquet(path)
        docs, rows = spark.read.parquet(path), got
    whole = {r.doc_id: r.n for r in pipeline.run(spark, folder).groupBy("doc_id").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()}
    last = {r.doc_id: r.n for r in pipeline.STAGES[4][1](spark, docs, folder).groupBy("doc_id").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()}
    assert whole == last and set(last) == {r[0] for r in rows}


def test_stages_take_empty_tables(spark, folder):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_near_copies_of_one_word_edits_go(spark):
    r = np.random.default_rng(4)
    words = [f"w{k}" for k in r.integers(0, 10**6, 600)]
    rows = [(1, " ".join(words), "en", "s", 0), (2, " ".join([*words[:300], "other", *words[301:]]), "en", "s", 0), (3, " ".join(f"v{k}" for k in r.integers(0, 10**6, 600)), "en", "s", 0), (4, " ".join(words), "en", "s", 0)]
    left = {x.doc_id for x in pipeline.near_copies(spark, spark.createDataFrame(rows, SCHEMA), "").collect()}
    assert {1, 3} <= left and 4 not in left
