import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from eventlake.llm import catalog, periodic


def brute(words):
    """All maximal repetitions, by comparing every position at every period."""
    n, found = len(words), set()
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(24, 3 * q):
                stretch = words[i:j + q]
                if not any(q % d == 0 and stretch[d:] == stretch[:-d] for d in range(1, q)):
                    found.add((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted(found)


def report(doc, words):
    found = brute(words)
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else None
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in found)]
    return (doc, len(words), len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(kept).encode()).hexdigest())


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def generated(seed):
    """A text of noise, cycles of many periods, cycles within cycles and breaks."""
    rng = random.Random(seed)
    words = []
    for _ in range(rng.randint(1, 5)):
        kind = rng.random()
        letters = "ab" if rng.random() < .4 else "abcdefghij"
        if kind < .3:
            words += [rng.choice(letters) for _ in range(rng.randint(0, 60))]
        else:
            cycle = [rng.choice(letters) for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 9, 13, 16, 17, 31, 40]))]
            if kind > .8:
                cycle = cycle * rng.randint(2, 9) + ["x"]
            words += (cycle * rng.randint(2, 30))[:rng.randint(20, 300)]
    return words


def thue_morse(n):
    return ["ab"[bin(i).count("1") & 1] for i in range(n)]


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


TEXTS = [" ".join(generated(i)) for i in range(150)] + [" ".join(f(600)) for f in (thue_morse, fibonacci)] + [
    "a " * 700, ("a " * 40 + "b ") * 12, ("a b " * 30 + "c ") * 7, "w " * 23, "w " * 24, " ".join("abcdefgh" * 3),
    " ".join("abcdefgh" * 3) + " a", "x " + "a b c\n" * 8 + " y", "", None, " \n\t", "é ü " * 30, "a b " * 30]


@pytest.mark.parametrize("tile,slice_bytes", [(1 << 18, 2 << 20), (64, 1), (200, 500)])
def test_equals_brute_force(spark, monkeypatch, tile, slice_bytes):
    monkeypatch.setattr(periodic, "TILE_WORDS", tile)
    monkeypatch.setattr(periodic, "SLICE_BYTES", slice_bytes)
    rows = [(i, t, 1) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], 1), (None, TEXTS[1], 1), (None, TEXTS[1], 1), (None, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(2)
    got = [tuple(r) for r in periodic.collapse(docs).collect()]
    assert order(got) == order([report(d, split(t)) for d, t, _ in rows])


def split(text):
    return [w.decode() for w in (text or "").encode().split()]


@pytest.mark.parametrize("tile", [16, 50, 300])
def test_pieces_of_long_texts_stitch(tile):
    for seed in range(150, 400):
        words = generated(seed)
        if not words:
            continue
        ids = periodic.word_ids(words)
        parts = []
        for low, base, stop, lo, hi in periodic.tiles_of(len(words), tile):
            piece = ids[base:stop]
            for t, q, s, e in periodic.fragments(piece, np.zeros(len(piece), int), np.zeros(1, int), np.array([len(piece)]), [low],
                                                 (lo - base, hi - base)):
                parts.append((t, q, s + base, e + base))
        if not parts:
            assert not brute(words)
            continue
        _, q, s, e = periodic.joined(*map(np.concatenate, zip(*parts)))
        got = sorted((a, b - a + p, p) for a, b, p in zip(s.tolist(), e.tolist(), q.tolist()) if b - a + p >= max(24, 3 * p))
        assert got == brute(words), (seed, tile)


def test_a_text_of_one_word_has_few_fragments():
    n = 200_000
    parts = periodic.fragments(np.zeros(n, int), np.zeros(n, int), np.zeros(1, int), np.array([n]), periodic.octaves(n))
    assert sum(len(p[0]) for p in parts) < n


def test_query_equals_brute_force(spark):
    from tests.conftest import SF_SMALL
    got = [tuple(r) for r in catalog.op12_periodic(spark, SF_SMALL).collect()]
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    want = []
    for doc, text in docs.items():
        words = [w.decode() for w in catalog.with_planted_cycle(doc, [w.encode() for w in split(text)])]
        if len(words) <= 900:
            want.append(report(doc, words))
    assert Counter(r[0] for r in got) == Counter(list(docs))
    keep = {w[0] for w in want}
    assert order([r for r in got if r[0] in keep]) == order(want)
    assert any(r[2] for r in want)


def test_empty_table(spark):
    assert periodic.collapse(spark.createDataFrame([], "doc_id long, text string")).count() == 0
