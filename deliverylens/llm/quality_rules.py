"""Quality rules: a learned decision list over per-document statistics.

``text_stats`` computes one row of statistics a document; ``learn`` grows and
prunes threshold conjunctions by sequential covering on labelled statistics;
``DecisionList.column`` emits the list as one Spark conditional expression, so
scoring runs in the JVM.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .session import workers_import_this

STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_upper long, n_digits long, n_lines long"
#: Ratios the rules may test, as SQL over the statistics.
FEATURES = {
    "n_words": "double(n_words)",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_words": "n_repeat_words / greatest(n_words, 1)",
    "upper": "n_upper / greatest(word_chars, 1)",
    "digits": "n_digits / greatest(word_chars, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
}
REPEAT_WINDOW = 8
BASE_FAILED = "n_words < 20 OR 100 * n_repeat_words > 30 * n_words"
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def stats_of(text: bytes) -> tuple[int, ...]:
    """The statistics of one UTF-8 text, in the order of STATS."""
    buf = np.frombuffer(text, dtype=np.uint8)
    starts, ends = W.spans(buf)
    n = len(starts)
    lines = [x for x in text.split(b"\n") if x.strip()]
    hashes = W.word_hashes(buf, starts, ends)
    twice = np.flatnonzero(W.repeated(W.window_hashes(hashes, REPEAT_WINDOW)))
    chars = int(np.count_nonzero((buf & 0xC0) != 0x80)) - int(np.count_nonzero(W.IS_SPACE[buf]))
    return (
        n,
        chars,
        int(np.count_nonzero(_SYMBOL[buf])),
        len(lines) - len(set(lines)),
        int(np.count_nonzero(W.covered(n, twice, twice + REPEAT_WINDOW))) if len(twice) else 0,
        int(np.count_nonzero((buf >= 65) & (buf <= 90))),
        int(np.count_nonzero((buf >= 48) & (buf <= 57))),
        len(lines),
    )


def text_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the STATS columns added to each row.

    A null text counts as empty: all statistics are zero. Columns of the input
    that have the name of a statistic are replaced.
    """
    workers_import_this(docs.sparkSession)
    names = [x.split()[0] for x in STATS.split(", ")]
    docs = docs.drop(*names)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [stats_of((t.as_py() or "").encode()) for t in batch.column(at)]
            cols = zip(*rows) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, pa.int64()) for c in cols)], names=[*batch.schema.names, *names])

    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T.LongType()) for n in names)])
    return docs.mapInArrow(run, schema)


@dataclass(frozen=True)
class Rule:
    """All conditions (feature, at_least, threshold) hold: reject."""

    conditions: tuple[tuple[str, bool, float], ...]
    precision: float
    covers: int

    def sql(self) -> str:
        return " AND ".join(f"({FEATURES[f]}) {'>=' if up else '<'} {t!r}D" for f, up, t in self.conditions)


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules; the first that holds rejects, otherwise the text is kept."""

    rules: tuple[Rule, ...] = field(default=())

    def column(self) -> Column:
        """The number (from 1) of the first rule that holds, else null."""
        if not self.rules:
            return F.lit(None).cast("int")
        out = None
        for k, rule in enumerate(self.rules, 1):
            out = F.when(F.expr(rule.sql()), F.lit(k)) if out is None else out.when(F.expr(rule.sql()), F.lit(k))
        return out


def _holds(x: dict[str, np.ndarray], conditions) -> np.ndarray:
    out = np.ones(len(next(iter(x.values()))), dtype=bool)
    for f, up, t in conditions:
        out &= (x[f] >= t) if up else (x[f] < t)
    return out


def _grow(x, bad, live, max_conditions: int, cuts: int):
    """Add the condition of highest FOIL gain until no good row is left."""
    chosen, inside = [], live.copy()
    while len(chosen) < max_conditions:
        p, n = int(np.sum(bad & inside)), int(np.sum(~bad & inside))
        if p == 0 or n == 0:
            break
        base, best = np.log2(p / (p + n)), (1e-9, None, None)
        for f, v in x.items():
            seen = np.unique(v[inside])
            if len(seen) < 2:
                continue
            mids = (seen[1:] + seen[:-1]) / 2
            if len(mids) > cuts:
                mids = np.unique(np.quantile(v[inside & bad], np.linspace(0, 1, cuts)))
            order = np.sort(v[inside & bad]), np.sort(v[inside & ~bad])
            below = [np.searchsorted(o, mids, side="left") for o in order]
            for up in (True, False):
                pos, neg = ((p - below[0], n - below[1]) if up else (below[0], below[1]))
                gain = np.where(pos > 0, pos * (np.log2(np.maximum(pos, 1) / np.maximum(pos + neg, 1)) - base), -1.0)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), (f, up, float(mids[k])), None)
        if best[1] is None:
            break
        chosen.append(best[1])
        inside &= _holds(x, chosen[-1:])
    return chosen


def _prune(x, bad, live, conditions):
    """Drop conditions while (p - n) / (p + n) on the pruning rows does not fall."""

    def worth(cs) -> float:
        inside = live & _holds(x, cs)
        p, n = int(np.sum(inside & bad)), int(np.sum(inside & ~bad))
        return (p - n) / (p + n) if p + n else -1.0

    best = list(conditions)
    while len(best) > 1:
        tries = [(worth(best[:k] + best[k + 1 :]), -k) for k in range(len(best))]
        top, k = max(tries)
        if top < worth(best):
            break
        best.pop(-k)
    return best


def learn(x: dict[str, np.ndarray], bad: np.ndarray, *, max_rules: int = 12, max_conditions: int = 4, min_precision: float = 0.9, min_covers: int = 20, cuts: int = 256, seed: int = 11) -> DecisionList:
    """Sequential covering: grow on two thirds of the rows, prune on the rest.

    A rule is kept if at least ``min_precision`` of the rows it covers are bad,
    on all rows and on the pruning rows, and it covers ``min_covers`` rows.
    """
    if not len(bad) or not bad.any() or bad.all():
        return DecisionList()
    pruning = np.random.default_rng(seed).random(len(bad)) < 1 / 3
    left, rules = np.ones(len(bad), dtype=bool), []
    while len(rules) < max_rules and (left & bad).any():
        grown = _grow(x, bad, left & ~pruning, max_conditions, cuts)
        if not grown:
            break
        pruned = _prune(x, bad, left & pruning, grown)
        done = None
        for conditions in (pruned, grown):
            inside = left & _holds(x, conditions)
            held = inside & pruning
            if inside.sum() >= min_covers and bad[inside].mean() >= min_precision and (not held.any() or bad[held].mean() >= min_precision):
                done = Rule(tuple(conditions), float(bad[inside].mean()), int(inside.sum()))
                break
        if done is None:
            break
        rules.append(done)
        left &= ~inside
    return DecisionList(tuple(rules))


def learn_from(docs: DataFrame, labels: DataFrame, *, max_rows: int = 20000, **how) -> DecisionList:
    """Fit on at most ``max_rows`` labelled documents, chosen by a hash of the id;
    of these, on those that pass the base conditions (the others go in any case).

    ``labels`` has doc_id and quality (0 is bad). Rows with a null label or id
    are left out; of repeated labels the worst counts.
    """
    good = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    good = good.withColumn("o", F.xxhash64("doc_id"))
    n = good.count()
    if n > 2 * max_rows:  # so that tasks send little more than what is used
        good = good.where(F.pmod("o", F.lit(1 << 30)) < int((1 << 30) * 1.5 * max_rows / n))
    sample = good.orderBy("o", "doc_id").limit(max_rows).drop("o")
    # At most max_rows pairs of numbers: a bound that holds at any size of the corpus.
    stats = text_stats(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")).where(f"NOT ({BASE_FAILED})")
    rows = stats.select("doc_id", *(F.expr(f"double({e})").alias(f"f_{k}") for k, e in FEATURES.items()), "quality").dropDuplicates(["doc_id"])
    got = rows.toPandas().sort_values("doc_id")
    x = {k: got[f"f_{k}"].to_numpy(dtype=np.float64) for k in FEATURES}
    return learn(x, got["quality"].to_numpy() == 0, **how)


def judge(docs: DataFrame, labels: DataFrame, *, max_rows: int = 20000, **how) -> tuple[DataFrame, DecisionList]:
    """``docs`` with statistics, ``base_failed``, ``rule`` and ``kept``; and the rules.

    base_failed: under 20 words, or over 30 % of the words in repeated windows.
    rule: the number of the learned rule that rejects, null if none does or if
    base_failed. Every row is judged by its own text, whatever its id: null and
    repeated ids are no matter. A null or empty text fails; an empty table
    gives an empty result; without usable labels no rule is learned. Columns of
    the input with these names are replaced.
    """
    rules = learn_from(docs, labels, max_rows=max_rows, **how)
    out = text_stats(docs.drop("base_failed", "rule", "kept")).withColumn("base_failed", F.expr(BASE_FAILED))
    out = out.withColumn("rule", F.when(~F.col("base_failed"), rules.column()))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()), rules
