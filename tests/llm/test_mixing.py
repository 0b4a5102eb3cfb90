import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from eventlake.llm import mixing


def fill(sizes, weights=(3, 1, 2), total=1.5, cap=2.0):
    """Clamp, share the excess by weight, again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    clamped = set()
    while True:
        left = total * sum(sizes.values()) - sum(cap * sizes[s] for s in clamped)
        free = [s for s in names if s not in clamped]
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > cap * sizes[s]}
        if not over:
            return {s: cap * sizes[s] if s in clamped else share[s] for s in names}
        clamped |= over


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


ROWS = [(i, "w " * (1 + i * 7 % 23), f"s{i % 3}" if i % 9 else None) for i in range(200)]
ROWS += [(300, None, "s0"), (301, "", "empty"), (302, "x", "Z"), (7, "w " * 8, "s1"), (7, "w " * 8, "s1"), (None, "a b c", "s2"),
         (400, "long " * 4000, "s2")]


@pytest.mark.parametrize("digits", [3, 1])
def test_targets_and_taken_words(spark, monkeypatch, digits):
    monkeypatch.setattr(mixing, "HEX_DIGITS", digits)
    docs = spark.createDataFrame([(*r, 9) for r in ROWS], "doc_id long, text string, source string, size int")
    rows = mixing.mix_report(docs).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in ROWS)
    sizes = Counter()
    for _, t, s in ROWS:
        sizes[s] += words(t)
    target = fill(sizes)
    want = defaultdict(float)
    per_source = defaultdict(list)
    for d, t, s in ROWS:
        per_source[s].append((hashlib.md5(f"7:{'null' if d is None else d}".encode()).hexdigest(), d, words(t)))
    got = Counter((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in rows)
    expected = Counter()
    for s, members in per_source.items():
        whole = int(target[s] // sizes[s]) if sizes[s] else 0
        reached, taken = 0, 0
        for _, d, n in sorted(members, key=lambda m: (m[0], m[2])):
            reached += n
            extra = reached - n / 2 <= target[s] - whole * sizes[s]
            expected[(d, n, sizes[s], round(target[s], 6), min(whole + extra, 2) * n)] += 1
            taken += min(whole + extra, 2) * n
        assert abs(taken - target[s]) <= max(m[2] for m in members) / 2 + 1e-6
    assert got == expected


def test_mix_repeats_rows_and_keeps_columns(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, source string").withColumn("_plan", F.lit("p"))
    taken = Counter()
    for r in mixing.mix_report(docs).collect():
        taken[r.doc_id] += r.taken
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    got = Counter()
    for r in out.collect():
        got[r.doc_id] += words(r.text)
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in taken.items() if v}


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "a b", None)], [(1, "a", "x"), (2, "", "y")]])
def test_small_tables(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert mixing.mix_report(docs).count() == len(rows)
