import random
import re
import resource

import pytest

from eventlake.llm import decontaminate as dc


def plain(text):
    return re.sub(r"[\W_]+", " ", (text or "").lower()).strip()


def least_edits(item, text):
    """Edits between ``item`` and its best stretch of ``text``, by the full table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def brute(docs, bench):
    out = []
    for d, t in docs:
        for b, item in bench:
            p = plain(item)
            if len(p) >= dc.Q:
                budget = min(int(len(p) * dc.EDIT_RATE), (len(p) - dc.Q) // dc.Q)
                e = least_edits(p, plain(t))
                if e <= budget:
                    out.append((d, b, e))
    return out


def words(rng, n):
    return " ".join("".join(rng.choice(["an", "re", "tion", "öl", "k", "7"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def edited(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        i = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[i] = "x"
        elif kind == 1:
            chars.insert(i, "y")
        else:
            del chars[i]
    return "".join(chars)


def key(rows):
    return sorted(rows, key=str)


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(3)
    bench = [(i, words(rng, rng.randint(4, 25))) for i in range(12)]
    bench += [(20, ""), (21, None), (None, "A missing number, still a passage"), (3, bench[3][1]), (22, "short")]
    docs = [(0, None), (1, ""), (2, "..."), (3, "A missing, number still -- a passage")]
    for i in range(4, 60):
        parts = [words(rng, rng.randint(0, 30)) for _ in range(3)]
        for _ in range(rng.randint(0, 2)):
            item = rng.choice(bench)[1] or "?"
            parts.insert(rng.randint(0, 3), edited(rng, item, rng.randint(0, max(1, len(item) // 9))).upper())
        docs.append((i, ("\n" if i % 2 else " ").join(parts)))
    # halves of one passage that end and begin neighbouring documents
    docs += [(60, bench[0][1][:30]), (61, bench[0][1][30:]), (7, docs[7][1]), (None, bench[1][1]), (62, bench[2][1] + "\0" + bench[2][1])]
    return docs, bench


def test_matches_brute_force(spark, tables):
    docs, bench = tables
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, item_id int").coalesce(2)
    b = spark.createDataFrame([(i, t, "x") for i, t in bench], "item_id long, text string, edits string")
    got = [tuple(r) for r in dc.contaminated(d, b).collect()]
    want = brute(docs, bench)
    assert len(want) > 20
    assert key(set(got)) == key(set(want))
    bad = {i for i, *_ in want}
    kept = dc.clean(d, b)
    assert kept.columns == d.columns
    assert key(r.doc_id for r in kept.collect()) == key(i for i, _ in docs if i not in bad)


def test_benchmark_in_parts_gives_the_same(spark, tables, monkeypatch):
    docs, bench = tables
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    whole = key(map(tuple, dc.contaminated(d, b).collect()))
    left = key(map(tuple, dc.clean(d, b).collect()))
    parts = dc.benchmark_parts(b, 400)
    assert len(parts) > 2 and sum(p.count() for p in parts) == len(bench)
    monkeypatch.setattr(dc, "benchmark_parts", lambda _: parts)
    assert key(map(tuple, dc.contaminated(d, b).collect())) == whole
    assert key(map(tuple, dc.clean(d, b).collect())) == left


def test_a_long_item_is_found_by_any_passage():
    rng = random.Random(5)
    item = words(rng, 400)
    p = dc.Passages([item])
    assert len(p.item) > 3
    assert p.found([plain(item)[700:700 + 2 * dc.PASSAGE], "nothing here", item])[0].tolist() == [0, 2]


def test_a_stretch_of_a_long_item_is_found_wherever_it_begins():
    rng = random.Random(6)
    item = plain(words(rng, 300))[:1000].strip()
    p = dc.Passages([item])
    around = words(rng, 20), words(rng, 20)
    for size in (201, 400, 600):
        texts = [f"{around[0]} {item[at:at + size]} {around[1]}" for at in range(len(item) - size + 1)]
        assert p.found(texts)[0].tolist() == [*range(len(texts))]
    assert not len(p.found([*around, item[:60]])[0])


def test_half_of_an_item_with_edits_is_found():
    rng = random.Random(7)
    item = plain(words(rng, 100))[:400].strip()
    p = dc.Passages([item, "another item of some length, whole"])
    halves = [item[:len(item) // 2 + 1], item[len(item) // 2 - 1:], item[100:300]]
    texts = [words(rng, 9) + " " + edited(rng, h, 4) + " " + words(rng, 9) for h in halves]
    texts += [item, edited(rng, item, 9)]
    text, found, edits = p.found(texts)
    assert text.tolist() == [0, 1, 2, 3, 4] and not found.any()
    assert edits[3] == 0 and edits[4] == least_edits(item, texts[-1])


def repetitive(rng, n):
    return "".join(rng.choice(["a" * rng.randint(1, 30), "ha " * rng.randint(1, 12), words(rng, 2), "b"]) for _ in range(n))


def test_repetitive_texts_match_brute_force(monkeypatch):
    rng = random.Random(11)
    items = ["a" * 60, "ha " * 25, "a" * 40 + "b" + "a" * 40, "ha " * 9 + words(rng, 4), *[repetitive(rng, 4) for _ in range(8)]]
    texts = [repetitive(rng, rng.randint(0, 12)) for _ in range(120)]
    texts += [items[i][:45] + edited(rng, items[i], 3) + "b" * i for i in range(len(items))]
    want = brute([*enumerate(texts)], [*enumerate(items)])
    assert len(want) > 40 and any(e for *_, e in want)
    p = dc.Passages(items)
    assert len(p.often_owner)
    for block, segment in ((dc.BLOCK, dc.SEGMENT), (50, 64)):
        monkeypatch.setattr(dc, "BLOCK", block)
        monkeypatch.setattr(dc, "SEGMENT", segment)
        assert key(map(tuple, zip(*(a.tolist() for a in p.found(texts)), strict=True))) == key(want)


def test_a_very_long_text_of_one_character_takes_bounded_memory():
    p = dc.Passages(["a" * 400, "ha " * 130])
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    text, item, edits = p.found(["a" * 2_000_000])
    assert (text.tolist(), item.tolist(), edits.tolist()) == ([0], [0], [0])
    assert p.found(["ha " * 400_000 + "end", "b" * 50])[1].tolist() == [1]
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1 << 20  # KB


def test_items_of_one_template():
    rng = random.Random(12)
    template = plain(words(rng, 40))[:136].strip()
    items = [f"{template} {rng.randrange(10 ** 9)}" for _ in range(150)]
    texts = [f"{words(rng, 30)} {template} {rng.randrange(10 ** 9)} {words(rng, 5)}" for _ in range(10)]
    got = dc.Passages([*items, items[0]]).found(texts)
    want = brute([*enumerate(texts[:1])], [*enumerate(items[:20])])
    first = [(t, i, e) for t, i, e in zip(*(a.tolist() for a in got), strict=True) if t == 0]
    assert [x for x in first if x[1] < 20] == want
    assert [x[2] for x in first if x[1] == 0] == [x[2] for x in first if x[1] == 150]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "text of some length")], "doc_id long, text string")
    assert dc.contaminated(none, spark.createDataFrame([(1, "text of some length")], "item_id long, text string")).count() == 0
    assert dc.contaminated(some, items).count() == 0
    assert dc.clean(some, items).count() == 1
