"""The near-copy stage against all pairs of documents."""

import random
from collections import defaultdict

import numpy as np

import corpus_pipeline as pipeline
from deliverylens.llm import near_dup

SCHEMA = "doc_id long, text string"


def plain(text):
    words = (text or "").split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def jaccard(x, y):
    return len(x & y) / len(x | y) if x | y else 1.0


def brute_groups(rows):
    sets = {i: plain(t) for i, t in rows}
    group = {i: i for i in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and jaccard(sets[a], sets[b]) >= 0.8]
    while changed:
        changed = False
        for a, b in links:
            least = min(group[a], group[b])
            changed |= group[a] != least or group[b] != least
            group[a] = group[b] = least
    return group, {(a, b): jaccard(sets[a], sets[b]) for a, b in links}


def edited(words, r, n):
    words = list(words)
    for k in r.sample(range(len(words)), n):
        words[k] = f"e{r.randint(0, 10**9)}"
    return words


def run(spark, rows):
    return {x.doc_id: x.group_id for x in near_dup.groups(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}


def test_members_that_miss_their_leader_still_meet(spark):
    """Versions of one template: each is under 0.8 with the smallest, some are over it with another."""
    r = random.Random(3)
    template = [f"t{k}" for k in range(300)]
    rows = [(0, " ".join(template))]
    for k in range(12):
        far = edited(template, r, 20)
        rows += [(3 * k + 1, " ".join(far)), (3 * k + 2, " ".join(edited(far, r, 3))), (3 * k + 3, " ".join(template[:100] + far[100:]))]
    want, links = brute_groups(rows)
    assert sum(a > 0 for a, _ in links) >= 12 and len(set(want.values())) > 5
    got = run(spark, rows)
    least = defaultdict(set)
    for i, g in got.items():
        least[g].add(i)
    assert got == want and all(min(v) == g for g, v in least.items())


def test_every_pair_of_the_lowest_band_is_found(spark):
    """Pairs with a similarity of 0.80 to 0.85, of texts of 60 to 1,000 common words."""
    r = random.Random(7)
    vocabulary = [f"v{k}" for k in range(3000)]
    weights = [1 / (k + 1) for k in range(3000)]
    rows, n = [], 0
    while n < 150:
        words = r.choices(vocabulary, weights, k=r.choice([60, 150, 400, 1000]))
        copy = list(words)
        for k in r.sample(range(len(words)), max(1, round(len(words) * 0.02))):
            copy[k] = r.choices(vocabulary, weights)[0]
        if 0.8 <= jaccard(plain(" ".join(words)), plain(" ".join(copy))) < 0.85:
            rows += [(2 * n, " ".join(words)), (2 * n + 1, " ".join(copy))]
            n += 1
    want, links = brute_groups(rows)
    assert len(links) >= 150
    assert run(spark, rows) == want


def test_the_whole_sets_decide_at_the_threshold(spark):
    """Exactly 0.8 is in, the next possible value below is out, whatever the length."""
    rows = []
    for k in range(40):
        n = 4 + 18 * (k + 1)  # a multiple of 18 shingles
        words = [f"k{k}w{j}" for j in range(n)]
        out = (n - 4) // 9
        for i, cut in enumerate((out, out + 1)):  # (n - 4 - cut) / (n - 4 + cut) is 0.8 for the first
            rows.append((10 * k + 1 + i, " ".join(words[: n - cut] + [f"x{k}y{i}z{j}" for j in range(cut)])))
        rows.append((10 * k, " ".join(words)))
        assert jaccard(plain(rows[-1][1]), plain(rows[-3][1])) == 0.8 > jaccard(plain(rows[-1][1]), plain(rows[-2][1]))
    first_two = [(i, t) for i, t in rows if i % 10 != 2]
    assert run(spark, first_two) == {i: 10 * (i // 10) for i, _ in first_two}
    other = [(i, t) for i, t in rows if i % 10 != 1]
    assert run(spark, other) == {i: i for i, _ in other}


def test_the_stage_keeps_one_of_each_group(spark):
    r = random.Random(9)
    rows = []
    for k in range(25):
        words = [f"g{k}w{r.randint(0, 200)}" for _ in range(220)]
        rows += [(5 * k + j, " ".join(edited(words, r, n))) for j, n in enumerate((0, 3, 4, 5, 6))]
    want, _ = brute_groups(rows)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert {x.doc_id for x in pipeline.near_copies(spark, docs, "").collect()} == set(want.values())


def test_bitmaps_never_differ_in_more_bits_than_sets_in_shingles():
    """Both kinds, for sets of any two sizes, empty ones included."""
    r = np.random.default_rng(5)
    for _ in range(300):
        both, x, y = (r.integers(-(2**63), 2**63, r.integers(0, most)) for most in (900, 120, 120))
        a, b = np.unique(np.concatenate([both, x])), np.unique(np.concatenate([both, y]))
        apart = len(np.setxor1d(a, b))
        assert near_dup.differ(near_dup.bitmap(a), near_dup.bitmap(b)) <= apart
        assert near_dup.differ(near_dup.bitmap(a, 64 * near_dup.FOLD), near_dup.bitmap(b, 64 * near_dup.FOLD)) <= apart


def test_a_large_group_of_edited_copies_is_one(spark):
    """Versions of one text beside texts that share a passage with it: the group is whole, the others stay."""
    r = random.Random(21)
    base = [f"b{r.randint(0, 10**6)}" for _ in range(250)]
    rows = [(k, " ".join(edited(base, r, r.randint(0, 4)))) for k in range(120)]
    rows += [(500 + k, " ".join(base[:60] + [f"o{k}w{j}" for j in range(150)])) for k in range(40)]
    want, _ = brute_groups(rows)
    assert len({want[k] for k in range(120)}) == 1 and all(want[500 + k] == 500 + k for k in range(40))
    assert run(spark, rows) == want
