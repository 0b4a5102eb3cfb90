import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from eventlake.llm import simhash


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(ids, fps, most=3):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= most:
                root[find(i)] = find(j)
    best = {}
    for i, d in enumerate(ids):
        r = find(i)
        if d is not None and (best.get(r) is None or d < best[r]):
            best[r] = d
    return [best.get(find(i)) for i in range(len(fps))]


TEXTS = ["", None, "One", "one two", "A b\tc\x0b d", "a  b c d", "x y z " * 400, "x y z " * 401 + "q",
         "ÄB cd ef gh ij kl", "äb cd ef gh ij kl", " one two three", "   ",
         " ".join(f"w{i}" for i in range(700)), " ".join(f"w{i}" for i in range(699)) + " other"]


def test_matches_brute_force(spark):
    rows = [(i, t, "k") for i, t in enumerate(TEXTS)] + [(None, "lonely text here now", "k"), (3, "one two", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = simhash.near_duplicates(docs).collect()
    fps = [brute_fingerprint(t) for _, t, _ in rows]
    want = brute_components([r[0] for r in rows], fps)
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(map(tuple, got), key=key) == sorted(
        ((r[0], f"{f:016x}", c) for r, f, c in zip(rows, fps, want)), key=key)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.keep_one(docs).count() == 0


def _cloud(rng, n, centres, flips):
    base = rng.integers(0, 2 ** 63, centres, dtype=np.uint64)
    out = base[rng.integers(0, centres, n)]
    for _ in range(flips):
        out = out ^ (np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64))
    return np.unique(out)


@pytest.mark.parametrize("n,centres,flips", [(300, 5, 2), (400, 40, 4), (200, 200, 0), (1, 1, 0)])
def test_index_finds_the_components(n, centres, flips):
    fps = _cloud(np.random.default_rng(n + flips), n, centres, flips)
    root = simhash.local_components(fps, np.array([0]), 3, block=32)
    want = brute_components(list(range(len(fps))), [int(f) for f in fps])
    assert root.tolist() == want


@pytest.mark.parametrize("max_group", [1 << 17, 8])
def test_routing_and_splitting_lose_no_link(spark, max_group):
    fps = _cloud(np.random.default_rng(7), 250, 12, 3)
    df = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    got = {r.fp: r.root for r in simhash.components(df, 3, max_group).collect()}
    want = brute_components(list(range(len(fps))), [int(f) for f in fps])
    signed = fps.view(np.int64).tolist()
    groups = {}
    for i, w in enumerate(want):
        groups.setdefault(w, []).append(signed[i])
    for members in groups.values():  # a root has no row of its own
        assert {got.get(m, m) for m in members} == {min(members)}


def test_keep_one_keeps_every_column_and_one_row_of_each_group(spark):
    a, b = " ".join(f"w{i}" for i in range(700)), "quite another text of words"
    rows = [(5, a, "m"), (2, a, "n"), (2, a, "a"), (None, a, "x"), (9, b, None), (None, None, "p"), (None, "", "o"), (7, "z z", "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _fp string") \
        .withColumn("kinds", F.create_map(F.lit("k"), F.lit(1)))
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r._fp) for r in got.collect()), key=str) == sorted(
        [(2, "a"), (9, None), (None, "p"), (7, "p")], key=str)
