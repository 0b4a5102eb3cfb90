"""Operator 7, quality rules by gradient-boosted trees over document statistics.

Statistics of every whole text (words, symbols, duplicate lines, words in repeated
windows, shares of character kinds) feed boosted regression trees. Training is a plain
histogram method in numpy on a bounded sample of labelled rows, with a logistic loss.
Features listed in ``MONOTONE`` may only lower (-1) or raise (+1) the score: a split that
would turn the other way is not taken, and the middle of a split bounds what its sides may
still become. The trees are flattened into node arrays, and a block of documents walks all
trees together, one level at a time.

A document is kept if neither base rule fails it (too few words, too many repeated ones)
and the trees give it ``THRESHOLD`` or more.

Defined cases: a null or empty text has no word and fails the base rule; without labels of
both kinds the base rules decide alone; a doc_id labelled more than once counts by its
greatest label; a very long text is
learned from and scored whole; null and repeated doc_ids are rows like any other; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from eventlake.llm.common import id_and_text, map_batches, text_bytes, written
from eventlake.llm.textstats import SPACE, SYMBOLS, code_points, duplicate_lines, gaps, how_many, repeated_words, word_ids
from eventlake.llm.toxicity import labelled_sample

FOLDS, HELD_FOLD = 4, 2  # held out of training, for the accuracy tests
SAMPLE_ROWS = 12_000  # labelled rows trained on, at most
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
TREES, DEPTH, RATE, BINS = 60, 4, 0.2, 64
MIN_LEAF, RIDGE = 10, 1.0
THRESHOLD = 0.5

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("log_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share", "stop_share",
            "shout_share", "distinct_share", "next_repeat_share", "words_per_line", "short_line_share")
MONOTONE = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "shout_share": -1, "next_repeat_share": -1}

_UPPER, _DIGITS, _STOPS, _SHOUTS = bytes(range(65, 91)), b"0123456789", b".,;:", b"!?"


def base_counts(text: bytes, words: list[bytes], ids: np.ndarray) -> tuple[int, int, int, int, int]:
    points = code_points(text)
    return len(words), points - how_many(text, SPACE), how_many(text, SYMBOLS), duplicate_lines(text)[1], repeated_words(ids)


def statistics(text: bytes) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """The base counts and the trees' features of a text."""
    words = text.split()
    ids = word_ids(words)
    base = base_counts(text, words, ids)
    n, chars, symbols, dup, repeated = base
    lines = [len(x.split()) for x in text.split(b"\n")]
    lines = [k for k in lines if k] or [0]
    per_char, per_word = 1 / max(1, chars), 1 / max(1, n)
    features = (np.log1p(n), chars * per_word, symbols * per_char, dup / len(lines), repeated * per_word, how_many(text, _UPPER) * per_char,
                how_many(text, _DIGITS) * per_char, how_many(text, _STOPS) * per_char, how_many(text, _SHOUTS) * per_char,
                len(np.unique(ids)) * per_word, int((gaps(ids) == 1).sum()) * per_word, n / len(lines), sum(k <= 3 for k in lines) / len(lines))
    return base, features


def base_failed(counts: np.ndarray) -> np.ndarray:
    n, repeated = counts[:, 0], counts[:, 4]
    return (n < MIN_WORDS) | (100 * repeated > MAX_REPEATED_PERCENT * n)


# --- trees ------------------------------------------------------------------------

class Trees:
    """Node arrays of all trees: feature (-1 at a leaf), threshold, left and right node, value."""

    def __init__(self):
        self.feature, self.threshold, self.left, self.right, self.value = [], [], [], [], []
        self.roots: list[int] = []
        self.start = 0.0

    def node(self) -> int:
        for column, v in zip((self.feature, self.threshold, self.left, self.right, self.value), (-1, 0.0, 0, 0, 0.0), strict=True):
            column.append(v)
        return len(self.feature) - 1

    def flatten(self) -> Trees:
        self.feature, self.left, self.right, self.roots = (np.array(a, np.int32) for a in (self.feature, self.left, self.right, self.roots))
        self.threshold, self.value = np.array(self.threshold), np.array(self.value)
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Sum of the trees for each row; all rows and trees step down together."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            feature = self.feature[at]
            inner = feature >= 0
            below = x[rows, np.maximum(feature, 0)] <= self.threshold[at]
            at = np.where(inner, np.where(below, self.left[at], self.right[at]), at)
        return self.start + self.value[at].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _cuts(column: np.ndarray) -> np.ndarray:
    """Thresholds between neighbouring quantiles."""
    values = np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1], method="lower"))
    return values


def train(x: np.ndarray, y: np.ndarray, monotone: tuple[int, ...], trees: int = TREES) -> Trees:
    model = Trees()
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    model.start = float(np.log(share / (1 - share)))
    cuts = [_cuts(x[:, f]) for f in range(x.shape[1])]
    codes = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)  # code <= k: value <= cuts[k]
    margin = np.full(len(x), model.start)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, hessian = y - p, np.maximum(p * (1 - p), 1e-6)
        model.roots.append(_grow(model, codes, cuts, gradient, hessian, np.arange(len(x)), DEPTH, -np.inf, np.inf, monotone, margin))
    return model.flatten()


def _leaf(g: float | np.ndarray, h: float | np.ndarray, low: float, high: float):
    return np.clip(RATE * g / (h + RIDGE), low, high)


def _gain(g, h, value):
    """Loss that a leaf of this value takes away (second order)."""
    v = value / RATE
    return g * v - 0.5 * (h + RIDGE) * v * v


def _grow(model, codes, cuts, gradient, hessian, rows, depth, low, high, monotone, margin) -> int:
    node = model.node()
    g, h = gradient[rows].sum(), hessian[rows].sum()
    value = float(_leaf(g, h, low, high))
    model.value[node] = value
    best = (1e-6, None)
    for f in range(codes.shape[1]) if depth and len(rows) >= 2 * MIN_LEAF else ():
        if not len(cuts[f]):
            continue
        size = len(cuts[f]) + 1
        left = [np.cumsum(np.bincount(codes[rows, f], w, size))[:-1] for w in (gradient[rows], hessian[rows], None)]
        lv, rv = _leaf(left[0], left[1], low, high), _leaf(g - left[0], h - left[1], low, high)
        gain = _gain(left[0], left[1], lv) + _gain(g - left[0], h - left[1], rv) - _gain(g, h, value)
        ok = (left[2] >= MIN_LEAF) & (len(rows) - left[2] >= MIN_LEAF) & (monotone[f] * (rv - lv) >= 0)
        k = int(np.argmax(np.where(ok, gain, -np.inf)))
        if ok[k] and gain[k] > best[0]:
            best = (gain[k], (f, k, lv[k], rv[k]))
    if best[1] is None:
        margin[rows] += value
        return node
    f, k, lv, rv = best[1]
    middle = (lv + rv) / 2
    bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[monotone[f]]
    side = codes[rows, f] <= k
    model.feature[node], model.threshold[node] = f, float(cuts[f][k])
    for name, part, (lo, hi) in (("left", rows[side], bounds[0]), ("right", rows[~side], bounds[1])):
        getattr(model, name)[node] = _grow(model, codes, cuts, gradient, hessian, part, depth - 1, lo, hi, monotone, margin)
    return node


# --- Spark side -------------------------------------------------------------------

def _measured(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    rows = [statistics(t) for t in texts]
    return np.array([r[0] for r in rows], np.int64).reshape(-1, len(BASE)), np.array([r[1] for r in rows]).reshape(-1, len(FEATURES))


def learn(docs: DataFrame, labels: DataFrame) -> Trees | None:
    """Trees from the sample; None without labels of both kinds."""
    sample = labelled_sample(docs, labels, "quality", FOLDS, HELD_FOLD, SAMPLE_ROWS)

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        _, x = _measured(text_bytes(batch.column(1)))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(x.tolist(), pa.list_(pa.float64())), batch.column(2)], names=["doc_id", "x", "y"])

    found = written(map_batches(sample.select("doc_id", "text", "y"), "text", "doc_id long, x array<double>, y int", rows), "rules-sample") \
        .orderBy("doc_id").collect()
    y = np.array([r.y > 0 for r in found], float)
    if not 0 < y.sum() < len(y):
        return None
    return train(np.array([r.x for r in found]), y, tuple(MONOTONE.get(f, 0) for f in FEATURES))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, the base counts, base_failed, kept, score."""
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, labels))

    def judged(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, x = _measured(text_bytes(batch.column(1)))
        failed = base_failed(counts)
        score = np.ones(len(x)) if shared.value is None else shared.value.score(x)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *map(pa.array, counts.T.copy()), pa.array(failed), pa.array(~failed & (score >= THRESHOLD)), pa.array(score)],
            names=["doc_id", *BASE, "base_failed", "kept", "score"])

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in BASE) + ", base_failed boolean, kept boolean, score double"
    return map_batches(id_and_text(docs), "text", schema, judged)
