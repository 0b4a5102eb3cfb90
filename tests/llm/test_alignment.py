import hashlib
import random
from collections import Counter

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from eventlake.llm import alignment
from eventlake.llm.token_counts import _byte_letters

TEXTS = ["The quick brown fox, it's 42 years old.", "a", " ", "  two  blanks ", "line\nfeeds\n\n and\ttabs\r\n", "naïve café – „quoted“ …",
         "日本語のテキスト", "emoji 👩‍👩‍👧 joined", "<|endoftext|> and <s> and </s> <unk> <0x41>", "a ▁ b", "\x00\x01", "fi ligature ﬁ and Ⅳ",
         "", None, "repeated words repeated words repeated words", "x" * 3000, "tepesİ. aİ!", "pre-tokenizers aren't words"]
ROWS = [(i, t, "en") for i, t in enumerate(TEXTS)] + [(3, TEXTS[0], "en"), (None, TEXTS[0], None), (99, "long text, " * 30000, "en")]


def sides(text):
    """(id, start, end) of every token on both sides, or nothing."""
    if not text:
        return [], []
    a = Tokenizer.from_file(P.path(alignment.A_FILE))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path(alignment.B_FILE))
    letters, out = _byte_letters(), []
    a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    pieces = [b.id_to_piece(i) for i in b_ids]
    for ids, parts in ((a_ids, [bytes(letters[c] for c in a.id_to_token(i)) for i in a_ids]),
                       (b_ids, [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
                                for i, p in zip(b_ids, pieces)])):
        if b"".join(parts) != (" " + text).encode():
            return [], []
        at, tokens = 0, []
        for i, p in zip(ids, parts):
            tokens.append((i, at, at + len(p)))
            at += len(p)
        out.append(tokens)
    return out


def brute(rows):
    tokens = [sides(t) for _, t, _ in rows]
    links = [[(x[0], y[0]) for end in sorted({x[2] for x in a} & {y[2] for y in b})
              for x in a if x[2] == end for y in b if y[2] == end] if len(a) < 5000 else fast(a, b) for a, b in tokens]
    count = Counter(p for ls in links for p in ls)
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = []
    for (doc, _, _), (a, b), ls in zip(rows, tokens, links):
        cuts, groups, lo = sorted({x[2] for x in a} & {y[2] for y in b}), [], 0
        i = j = 0
        for cut in cuts:
            k, m = i, j
            while k < len(a) and a[k][2] <= cut:
                k += 1
            while m < len(b) and b[m][2] <= cut:
                m += 1
            groups.append(",".join(str(x[0]) for x in a[i:k]) + "|" + ",".join(str(x[0]) for x in b[j:m]))
            i, j, lo = k, m, cut
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((doc, len(a), len(b), len(groups), len(ls), sum(count[p] == most[p[1]] for p in ls), sum(count[p] for p in ls), digest))
    return out


def fast(a, b):
    ends = {y[2]: y[0] for y in b}
    return [(x[0], ends[x[2]]) for x in a if x[2] in ends]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


FILES = P.path(alignment.A_FILE), P.path(alignment.B_FILE)


@pytest.mark.parametrize("slice_bytes", [1 << 20, 50])
def test_equals_brute_force(spark, monkeypatch, slice_bytes):
    monkeypatch.setattr(alignment, "SLICE_BYTES", slice_bytes)
    rows = ROWS if slice_bytes > 50 else ROWS[:-1]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, lang string, links int").repartition(3)
    got = [tuple(r) for r in alignment.align(docs, *FILES).collect()]
    want = brute(rows)
    assert order(got) == order(want)
    kinds = {r[0]: r[3] for r in want}
    assert kinds[9] == kinds[12] == kinds[13] == 0 < kinds[8]


def test_given_documents(spark):
    from tests.conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("length(text) < 6000")
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    got = [tuple(r) for r in alignment.align(docs, *FILES).collect()]
    assert order(got) == order(brute(rows))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(docs, *FILES).count() == 0


def test_overlaps_are_all_pairs_that_share_bytes(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS[:12])]
    got = {tuple(r) for r in alignment.overlap_table(spark.createDataFrame(rows, "doc_id long, text string"), *FILES).collect()}
    want = set()
    for doc, text in rows:
        a, b = sides(text)
        want |= {(doc, i, j, x[0], y[0], max(x[1], y[1]), min(x[2], y[2]), x[2] == y[2])
                 for i, x in enumerate(a) for j, y in enumerate(b) if max(x[1], y[1]) < min(x[2], y[2])}
    assert got == want


def vocabularies():
    return alignment.Vocabularies.of(*[open(f, "rb").read() for f in FILES])


def test_pairs_have_numbers_of_their_own():
    vocab = vocabularies()
    assert vocab.n_pairs <= 2 * vocab.a_len.sum() + vocab.b_len.sum()
    got = alignment.Aligned(vocab, [(t or "").encode() for t in TEXTS])
    pairs = {(a, b) for a, b in zip(got.a[got.link_a].tolist(), got.b[got.link_b].tolist())}
    assert len(pairs) == len(set(got.links.tolist()))
    assert (vocab.b_of()[got.links] == got.b[got.link_b]).all()


def test_cuts_equal_whole_texts():
    vocab, rng = vocabularies(), random.Random(3)
    marks = [" ", " ", "  ", "\n", "\t", " \n", "a", "the", "THE", "don't", "'s", "12", ".", ",", "é", "\u00a0", "\u3000 ", "\u2028", "\u0085 ", "日本", "👍",
             "ﬁ", "▁", "<s>", "<|endoftext|>", "\x00", "\x1c", "\u0301", "\r\n", "\u200b", "I", "ll", "'"]
    for marks_used in (marks, [m for m in marks if m not in ("ﬁ", "▁")]):
        texts = ["".join(rng.choice(marks_used) for _ in range(rng.randint(1, 14))).encode() for _ in range(8000)]
        a, n_a, b, n_b = alignment.encoded(vocab, texts)
        *want, good = alignment._whole(vocab, texts)
        for ids, n, lists in ((a, n_a, want[0]), (b, n_b, want[1])):
            flat, sizes = alignment._flat([x if g else [] for x, g in zip(lists, good.tolist())])
            assert ids.tolist() == flat.tolist() and n.tolist() == sizes.tolist()
