import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlake.llm import quality_knn, quality_rules
from eventlake.llm.textstats import gaps, repeated_words, word_ids
from eventlake.llm.toxicity import labelled_sample

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [None, "", " ", "\n\n", "a", "é", "日本 語", "one two\none two\n \n \none two ", "a b c d e f g h " * 2, "x " * 9, "x " * 8, "x\x0by\x0cz\x1cw\x85v",
         "## $% | <a> & *é", "a b c d e f g h i a b c d e f g h j", "same line\r\nsame line\r\nsame line", " ".join(f"w{i}" for i in range(400)),
         " ".join(f"w{i % 37}" for i in range(300)), "tail " * 30000 + "end"]


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    covered = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            n < 20 or 100 * len(covered) > 30 * n)


@pytest.fixture(scope="module")
def tables(spark):
    """Plain sentences, and junk of three kinds."""
    rng = np.random.default_rng(4)
    syllables = ["an", "re", "tion", "st", "ou", "the", "ê"]
    rows, labels = [], []
    for i in range(900):
        words = ["".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(rng.integers(25, 120))]
        good = i % 5 != 0
        if not good:
            words = [[w + "$$$" for w in words], [w.upper() + "!!" for w in words], [words[0]] * len(words)][i // 5 % 3]
        rows.append((i, " ".join(words) + "."))
        if i % 4:
            labels.append((i, int(good), 0))
    return rows, [*labels, (1, None, 0), (None, 1, 1), (5000, 0, 0)]


def held(i, folds, fold):
    return zlib.crc32(str(i).encode()) % folds == fold


def test_gaps_and_windows():
    ids = word_ids([b"a", b"b", b"a", b"a", b"c", b"b"])
    assert ids.tolist() == [0, 1, 0, 0, 4, 1]
    assert gaps(ids).tolist() == [0, 0, 2, 1, 0, 4]
    rng = np.random.default_rng(0)
    for n in (0, 7, 8, 9, 40, 200):
        for kinds in (1, 2, 3):
            words = [str(k) for k in rng.integers(0, kinds, n)]
            assert repeated_words(word_ids([w.encode() for w in words])) == brute(" ".join(words))[4]


def test_base_counts_match_brute_force(spark, tables):
    rows = [*enumerate(TEXTS), (3, "again"), (None, "no number")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit("x"))
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality_rules.judge(docs, marks).collect()
    key = lambda x: str(x)
    assert sorted(((r.doc_id, *r[1:7]) for r in got), key=key) == sorted(((d, *brute(t)) for d, t in rows), key=key)
    assert all(r.kept == (not r.base_failed) for r in got)


def test_trees_learn_and_keep_to_their_directions(spark, tables):
    rows, labels = tables
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = [r for r in quality_rules.judge(docs, marks).collect() if held(r.doc_id, 4, 2)]
    assert np.mean([r.kept == (r.doc_id % 5 != 0) for r in out]) > 0.97
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    y = ((x[:, 0] + 0.6 * np.sin(9 * x[:, 1]) + 0.4 * rng.standard_normal(3000)) > 0.6).astype(float)
    model = quality_rules.train(x, y, (1, -1, 0))
    assert np.mean((model.score(x) > 0.5) == y) > 0.7
    base = rng.random((200, 3))
    for f, way in ((0, 1), (1, -1)):
        steps = [model.margin(np.column_stack([np.full(200, v) if k == f else base[:, k] for k in range(3)])) for v in np.linspace(0, 1, 40)]
        assert (way * np.diff(steps, axis=0) >= -1e-9).all()


def test_flattened_walk_is_the_node_by_node_walk():
    rng = np.random.default_rng(2)
    x = rng.random((500, 4))
    y = (x[:, 0] * x[:, 1] > 0.3).astype(float)
    m = quality_rules.train(x, y, (0, 0, 0, 0), trees=5)
    for row, got in zip(x[:50], m.margin(x[:50]), strict=True):
        total = m.start
        for node in m.roots:
            while m.feature[node] >= 0:
                node = m.left[node] if row[m.feature[node]] <= m.threshold[node] else m.right[node]
            total += m.value[node]
        assert got == pytest.approx(total)


def test_neighbours_vote(spark, tables):
    rows, labels = tables
    extra = [(None, None), (2000, ""), (2001, "word " * 20000), rows[7]]
    docs = spark.createDataFrame([(*r, "s") for r in [*rows, *extra]], "doc_id long, text string, score string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality_knn.score(docs, marks).collect()
    assert len(got) == len(rows) + len(extra)
    for r in got:
        assert r.held_out == (r.doc_id is not None and held(r.doc_id, 4, 2))
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    out = [r for r in got if r.held_out and r.doc_id < 900]
    assert np.mean([r.predicted == int(r.doc_id % 5 != 0) for r in out]) > 0.97


def test_blocked_votes_match_brute_force():
    rng = np.random.default_rng(3)
    x, y = rng.random((60, quality_knn.TERMS)).astype(np.float32), rng.integers(0, 2, 60)
    v = quality_knn.Voters(x, y)
    q = rng.random((7, quality_knn.TERMS)).astype(np.float32)
    unit = lambda a: a / np.linalg.norm(a, axis=-1, keepdims=True)
    for row, got in zip(q, v.scores(q), strict=True):
        cosine = v.vectors @ unit(unit(row * v.idf) @ v.axes)
        near = sorted(range(60), key=lambda i: -cosine[i])[:quality_knn.NEIGHBOURS]
        weight = np.maximum(cosine[near], 1e-3).astype(float) ** quality_knn.SHARPNESS
        assert got == pytest.approx((weight * v.labels[near]).sum() / weight.sum(), rel=1e-3)


def test_held_out_labels_change_nothing(spark, tables):
    rows, labels = tables
    docs = spark.createDataFrame(rows[:300], "doc_id long, text string")
    one = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    other = one.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(map(tuple, quality_knn.score(docs, m).collect())) for m in (one, other))
    assert a == b


@pytest.mark.parametrize("size", [40_000, 54_000, 1_000_000])
def test_long_labelled_texts_are_learned_from(spark, size):
    rng = np.random.default_rng(6)
    syllables = np.array(["an", "re", "tion", "st", "ou", "the", "ri"])
    rows = []
    for i in range(160 if size < 100_000 else 60):
        words = ["".join(w) + " " for w in syllables[rng.integers(0, 7, (size // 40, 3))]]
        text = "".join(words) if i % 2 else "".join(w.strip().upper() + "!! $$ " for w in words)
        rows.append((i, (text * (size // len(text) + 1))[:size] if size < 100_000 else text * 4))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    marks = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    got = quality_knn.score(docs, marks).collect()
    assert all(r.predicted == r.doc_id % 2 for r in got)
    assert quality_rules.learn(docs, marks) is not None


def test_copies_count_once_and_texts_that_share_a_passage_each(spark):
    rng = np.random.default_rng(7)
    text = lambda n: " ".join(f"w{k}" for k in rng.integers(0, 10 ** 6, n))
    licence, base = text(60), text(300).split()
    near = [" ".join(base[:k] + ["changed"] + base[k + 1:]) for k in range(0, 300, 10)]
    rows = [*enumerate([text(200) + " " + licence for _ in range(100)]), *((200 + i, t) for i, t in enumerate([" ".join(base)] * 30 + near)), (300, None), (301, "")]
    docs = spark.createDataFrame([*rows, rows[0], (0, "another text of this number")], "doc_id long, text string")
    marks = spark.createDataFrame([(i, 1) for i, _ in rows], "doc_id long, quality int")
    got = [r.doc_id for r in labelled_sample(docs, marks, "quality", 4, 9, 1000).collect()]
    assert len(got) == len(set(got))
    assert sum(i < 100 for i in got) > 85
    assert sum(200 <= i < 300 for i in got) < 6


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality_knn.score(docs, marks).collect()} == {0.5}
    assert quality_knn.score(docs.limit(0), marks).count() == 0
    assert quality_rules.judge(docs.limit(0), marks).count() == 0
