import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlake.llm import pii

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d)))
            if (kind == 0 or kind == 1 and all(int(p) <= 255 for p in m.group().split("."))
                    or kind == 2 and 13 <= len(d) <= 19 and total % 10 == 0 or kind == 3 and 9 <= len(d) <= 15):
                out.append((kind, *m.span()))
    return out


TEXTS = [None, "", " ", "a@b.c@d.e x@@y.z @q.r a.b%c@d-e.f.g. me@host", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.255 1.2.3 0000000000001.2.3.4",
         "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 5500005555555559, 378282246310005x", "+1 (555) 010-4477 +49 30 123456 +1 2 +12345678901234567 ++1 234 567 8901",
         "write to anna.b@mail.example.org, (or) b@c.de!", "é4111111111111111é é@é.com x@é.com", "9" * 5000 + " " + "1." * 3000, "a" * 3000 + "@" + "b." * 2000 + "c",
         "+" * 500 + "1" * 20 + "(" * 500, "no data at all " * 400]


@pytest.fixture(scope="module")
def tagger():
    return pii.train(["some plain words that stand here, one after another. And more of them " * 20], steps=260)


def test_base_spans_match_the_patterns():
    rng = np.random.default_rng(0)
    letters = list("ab1234567890.@+- ()é,")
    random = ["".join(rng.choice(letters, 80)) for _ in range(3000)]
    for text in [t or "" for t in TEXTS] + random:
        assert pii.base_spans(text) == brute(text), text[:90]


def test_gradients():
    rng = np.random.default_rng(0)
    p = pii._initial(rng, 3)
    x, y = rng.integers(0, pii.CODES, (9, 4)), rng.integers(0, pii.TAGS, (9, 4))
    _, grad = pii.loss_and_gradients(p, x, y)
    for name, value in p.items():
        for _ in range(4):
            i = tuple(int(rng.integers(0, n)) for n in value.shape)
            kept, sides = value[i], []
            for step in (1e-5, -1e-5):
                value[i] = kept + step
                sides.append(pii.loss_and_gradients(p, x, y)[0])
            value[i] = kept
            assert (sides[0] - sides[1]) / 2e-5 == pytest.approx(grad[name][i], abs=1e-4, rel=1e-4)


def test_windows_run_side_by_side_as_alone_and_the_bound_is_exact():
    rng = np.random.default_rng(1)
    for trial in range(12):
        p = pii._initial(rng, 4)
        p["e"][0] = rng.random() * 8
        p["t"] = 2 * rng.standard_normal((pii.TAGS, pii.TAGS))
        t = pii.Tagger(p)
        text = rng.integers(0, pii.CODES, 300).astype(np.uint8)
        sizes = np.sort(rng.integers(1, 40, 30))[::-1].copy()
        starts = rng.integers(0, 300 - 40, 30)
        e, place = t.emissions(text, starts, sizes)
        tags = t.viterbi(e, place, sizes)
        undecided = set(t.undecided(e, place, sizes).tolist())
        for w, (a, n) in enumerate(zip(starts, sizes, strict=True)):
            alone, _ = t.emissions(text, np.array([a]), np.array([n]))
            assert np.allclose(alone, e[:, place[w]:place[w] + n], atol=1e-4)
            x = text[a:a + n][:, None].astype(int)
            full = np.stack([p["ef"] @ f[-1] + p["eb"] @ b[-1] + p["e"] for f, b in
                             zip(pii._run(p["xf"], p["hf"], x), pii._run(p["xb"], p["hb"], x[::-1])[::-1], strict=True)])[:, :, 0].T
            assert np.allclose(full, alone, atol=1e-3)
            if n <= 6 and trial < 4:
                paths = np.stack(np.meshgrid(*[range(pii.TAGS)] * n, indexing="ij"), -1).reshape(-1, n)
                score = alone[paths, np.arange(n)].sum(1) + (p["t"][paths[:, :-1], paths[:, 1:]].sum(1) if n > 1 else 0)
                got = alone[tags[w], np.arange(n)].sum() + p["t"][tags[w][:-1], tags[w][1:]].sum()
                assert got == pytest.approx(score.max(), abs=1e-3)
            if w not in undecided:
                assert not tags[w].any()


def test_both_gathers_give_the_same_numbers(tagger, monkeypatch):
    text = np.random.default_rng(2).integers(0, pii.CODES, 300).astype(np.uint8)
    sizes, starts = np.array([90, 60, 60, 7]), np.array([0, 5, 200, 290])
    both = []
    for by_rows in (True, False):
        monkeypatch.setattr(pii, "rows_are_quicker", lambda: by_rows)  # noqa: B023
        both.append(tagger.emissions(text, starts, sizes)[0])
    assert (both[0] == both[1]).all()


def test_held_out_accuracy(tagger):
    x, y = pii.training_windows(["other words for the test, none of them seen before"] * 3, np.random.default_rng(99), 300)
    sizes = np.full(300, pii.LENGTH)
    e, place = tagger.emissions(x.T.ravel(), np.arange(300) * pii.LENGTH, sizes)
    tags = np.array(tagger.viterbi(e, place, sizes)).T
    assert (tags == y).mean() > 0.97
    for kind in range(len(pii.KINDS)):
        assert (tags[y == kind + 1] == kind + 1).mean() > 0.75


# Written by hand; the generator cannot make the hosts, names and groupings of these.
SPANS = [("email", "bob.smith at example dot com"), ("email", "jane (at) server (dot) co"), ("email", "kim[at]host[dot]org"),
         ("ip", "fe80:1:2:3:4:5:6:7"), ("ip", "10[.]20[.]30[.]40"), ("ip", "192 . 168 . 7 . 21"),
         ("card", "4111.1111.1111.1111"), ("card", "5500/0055/5555/5559"), ("phone", "(555) 010-4477"), ("phone", "212-555-0100"), ("phone", "(212) 555 0199")]


def test_span_recall_on_writings_by_hand(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    tagger = pii.learn(docs)
    found = []
    for kind, written in SPANS:
        for text in (f"please write to {written} today", f"Contact: {written}.", f"the words before, {written}, and after"):
            spans = pii.reconciled(text, pii.base_spans(text), tagger.proposals([text])[0])
            found.append((pii.KINDS.index(kind), written) in {(k, text[a:b]) for k, a, b in spans})
    assert np.mean(found) > 0.75, [x for x, f in zip([x for x in SPANS for _ in range(3)], found, strict=True) if not f]
    text = "call (555) 010-4477 (555) 010-4478 now"
    spans = pii.reconciled(text, pii.base_spans(text), tagger.proposals([text])[0])
    assert [text[a:b] for _, a, b in spans] == ["(555) 010-4477", "(555) 010-4478"]


def test_a_span_longer_than_the_overlap_is_found_at_every_seam(tagger):
    """What is proposed does not depend on where the windows are cut."""
    span = "anna at " + " dot ".join(["mail", "host"] * 9) + " dot org"
    assert len(span) > pii.OVERLAP
    short = "some words here " + span + " and others there"
    alone = {short[a:b] for _, _, a, b in tagger.proposals([short])[0]}
    for before in range(pii.WINDOW - len(span) - 40, pii.WINDOW + 10, 37):
        text = ("plain words and more of them " * 60)[:before] + " some words here " + span + " and others there " + "plain words and more of them " * 60
        proposed = tagger.proposals([text])[0]
        for kind, a, b in {(k, a, b) for _, k, a, b in proposed}:
            assert a == 0 or b == len(text) or (a % (pii.WINDOW - pii.OVERLAP), b % pii.WINDOW) != (0, 0)
        assert {text[a:b] for _, _, a, b in proposed} >= alone


def test_added_spans_across_windows(tagger):
    filler = "plain words and more of them " * 200
    written = ["(555) 010-4477", "4111.1111.1111.1111", "2001:db8::ff00:42"]
    text = filler + written[0] + " " + filler[:pii.WINDOW - 20] + written[1] + " and " + filler + written[2] + " end, x@y.org"
    spans = pii.reconciled(text, pii.base_spans(text), tagger.proposals([text])[0])
    assert {text[a:b] for _, a, b in spans} >= {written[0], written[1], "x@y.org"}
    assert pii.base_spans(text)[0] in spans
    assert all(b <= c for (_, _, b), (_, c, _) in zip(sorted(spans, key=lambda s: s[1]), sorted(spans, key=lambda s: s[1])[1:], strict=False))


def test_reconciliation_takes_the_greatest_total():
    text = "(555) 010-4477 (555) 010-4478 a@b.c"
    base = pii.base_spans(text)
    one, two, both = (3.0, 3, 0, 14), (2.0, 3, 15, 29), (4.0, 3, 6, 20)
    assert pii.reconciled(text, base, [both, one, two, one, (9.0, 3, 30, 35)]) == [*base, (3, 0, 14), (3, 15, 29)]


def test_query_on_odd_texts(spark):
    rows = [*enumerate(TEXTS), (3, TEXTS[7]), (None, "call (555) 010-4477 or b@c.de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(1))
    got = pii.find(docs).collect()
    assert len(got) == len(rows)
    left = [(d, t) for d, t in rows]
    for r in got:
        d, t = next(x for x in left if x[0] == r.doc_id and
                    hashlib.sha256(",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in brute(x[1])).encode()).hexdigest() == r.base_sha256)
        left.remove((d, t))
        spans = [s.split(":") for s in r.spans.split(",") if s]
        assert {(pii.KINDS[k], str(a), str(b)) for k, a, b in brute(t)} <= set(map(tuple, spans))
        assert [sum(s[0] == k for s in spans) for k in pii.KINDS] == [r.n_email, r.n_ip, r.n_card, r.n_phone]
        order = [(pii.KINDS.index(k), int(a)) for k, a, _ in spans]
        assert order == sorted(order)
    assert pii.find(docs.limit(0)).count() == 0


def test_windows_cover_a_text_without_waste():
    for n in (0, 1, pii.WINDOW, pii.WINDOW + 1, 1100, 2000, 5000, 128_657):
        cuts = pii.cuts(n)
        assert sum(size for _, size in cuts) <= n + len(cuts) * (pii.OVERLAP + 1)
        assert all(size <= pii.WINDOW for _, size in cuts) and len({size for _, size in cuts}) <= 1
        assert not n or cuts[0][0] == 0 and sum(cuts[-1]) == n
        assert all(a + size - b >= pii.OVERLAP for (a, size), (b, _) in zip(cuts, cuts[1:], strict=False))


def test_arithmetic_tanh_is_close():
    z = np.linspace(-30, 30, 4001, dtype=np.float32).reshape(1, -1)
    out, s, q = (np.empty_like(z) for _ in range(3))
    pii.quick_tanh(z, out, s, q)
    assert np.abs(out - np.tanh(z.astype(np.float64))).max() < 1e-4
    pii.quick_tanh(z, z, s, q)
    assert (z == out).all()


def test_logistic_is_exact_and_saturates():
    z = np.linspace(-300, 300, 4001, dtype=np.float32).reshape(1, -1)
    exact = 1 / (1 + np.exp(z.astype(np.float64)))
    with np.errstate(over="ignore"):
        pii.logistic(z, z)
    assert np.abs(z - exact).max() < 1e-6


def test_windows_run_side_by_side_by_length(tagger, monkeypatch):
    monkeypatch.setattr(pii, "SIDE_CHARS", 3000)
    windows = [(0, 0, 900), (0, 800, 1000), (1, 0, 5), (2, 0, 7000), (2, 6900, 1000), (3, 0, 1000)]
    groups = pii._side_by_side(windows)
    assert sorted(w for g in groups for w in g) == sorted(windows)
    assert all(len(g) == 1 or sum(w[2] for w in g) <= 3000 for g in groups)
    # and the spans are the same, however few run together
    texts = ["call (555) 010-4477 or write to jo at host dot org, " + "plain words " * n for n in (3, 90, 300, 0)]
    few = tagger.proposals(texts)
    monkeypatch.setattr(pii, "SIDE_CHARS", 1 << 20)
    spans = lambda found: [sorted(s[1:] for s in f) for f in found]
    assert spans(few) == spans(tagger.proposals(texts)) and any(few)
