import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlake.llm import toxicity as tx


def brute_clause(symbols):
    """Best score over every choice of attacks to count, by the rules of the grammar."""
    attacks = [i for i, c in enumerate(symbols) if c in tx.ATTACKS]
    best = 0.0
    for n in range(len(attacks) + 1):
        for chosen in itertools.combinations(attacks, n):
            total, target, attack, left, reported = 0.0, False, False, 0, False
            for i, c in enumerate(symbols):
                if c in tx.ATTACKS:
                    total += tx.NEGATED * (left > 0) + tx.REPORTED * reported  # paid even where passed over
                    if i in chosen:
                        insult = c in tx.INSULT_LEVELS
                        level = (tx.INSULT_LEVELS if insult else tx.THREAT_LEVELS).index(c)
                        total += tx.LEVEL_WEIGHTS[level] * (1.0 if insult else 0.5) + tx.TARGET_BONUS * (target and not attack)
                        attack = True
                elif c == tx.TARGET[0]:
                    total += tx.TARGET_BONUS * (attack and not target)
                    target = True
                left = tx.SCOPE_WORDS if c == tx.NEGATION[0] else max(0, left - 1)
                reported = reported or c == tx.REPORT[0]
            best = max(best, total)
    return best


def test_clause_machine_matches_brute_force():
    rng = np.random.default_rng(0)
    machine = tx.scope_transducer().compose(tx.pattern_transducer())
    letters = np.frombuffer(tx.PLAIN + b"adeh", np.uint8)
    for _ in range(400):
        clause = bytes(rng.choice(letters, rng.integers(0, 9)))
        assert max(0.0, machine.best(clause)) == pytest.approx(brute_clause(clause)), clause


def test_composition_is_what_running_both_gives():
    machine, scope, pattern = tx.scope_transducer().compose(tx.pattern_transducer()), tx.scope_transducer(), tx.pattern_transducer()
    for clause in (b"", b"N.a", b"N....aY", b"RaY", b"YNh.c"):
        penalty, weight = scope.best(clause), pattern.best(clause)  # the scope passes symbols on
        assert machine.best(clause) == pytest.approx(penalty + weight)


def test_words_become_classes():
    lex = tx.Lexicon({"you": 89, "not": 78}, {"mor": 97, "moro": 100})
    assert lex.read("You, (MORONS!) more not\nmorality") == b"Y|d|aN" + b".|" + b"a"
    assert lex.read("") == b""


def fold(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for i in range(600):
        words = ["".join(rng.choice(list("abcdeilmnorstu"), rng.integers(2, 7))) for _ in range(rng.integers(5, 60))]
        toxic = i % 6 == 0
        for _ in range(3 if toxic else 0):
            words.insert(int(rng.integers(0, len(words))), rng.choice(["Zorgfal", "zorgfen,", "scum", "you idiot"]))
        rows.append((i, " ".join(words)))
        if i % 2 == 0:
            labels.append((i, 1, int(toxic)))
    labels += [(0, 0, 1), (0, 1, 0), (None, 1, 1), (2, 1, None), (9999, 1, 1)]
    return rows, labels


def test_learns_stems_and_scores_held_out_documents(spark, tables):
    rows, labels = tables
    docs = spark.createDataFrame([(*r, 0.5) for r in [*rows, rows[6], (None, None), (700, ""), (701, "word " * 20000)]], "doc_id long, text string, score double")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("text", F.lit("x"))
    got = tx.score(docs, marks).collect()
    assert len(got) == docs.count()
    assert "zorg" in tx.learn(docs, marks).lexicon.stems
    for r in got:
        assert r.held_out == (r.doc_id is not None and fold(r.doc_id))
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= tx.THRESHOLD)
    hit = [r.predicted == int(r.doc_id % 6 == 0) for r in got if r.doc_id is not None and r.doc_id < 600]
    assert sum(hit) >= 0.97 * len(hit)
    assert {r.predicted for r in got if r.doc_id in (700, None)} == {0}
    kept = tx.accepted(docs, marks)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(r.doc_id or -1 for r in got if not r.predicted)


def test_held_out_labels_change_nothing(spark, tables):
    rows, labels = tables
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    one = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    other = one.withColumn("toxic", F.when(tx.fold(F.col("doc_id"), 5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert sorted(map(tuple, tx.score(docs, one).collect())) == sorted(map(tuple, tx.score(docs, other).collect()))


@pytest.mark.parametrize("labels", [[], [(1, 1, 1)], [(1, 1, None), (None, None, None)]])
def test_few_labels_and_empty_tables(spark, labels):
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(1, "You idiot, you stupid moron. You are scum!"), (2, "A fine day.")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in tx.score(docs, marks).collect()}
    assert got[1] > got[2]
    assert tx.score(docs.limit(0), marks).count() == 0
