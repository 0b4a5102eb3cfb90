import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventlake.llm import token_pack as tp

PATH = public_tokenizers.path(tp.TOKENIZER)
TEXTS = [None, "", " ", "\n", "Hello, World. it's o'clock don't DON'T we'll'd", "a\x1cb\x85c d　e", "x  y\n\nz\t\r\nq",
         "İstanbul ΣΑΣ Σ ς straße ÉÈ é ́a ﬁ ½ ²", "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>", "wow!!, yes., no,. a., é, é. '.",
         "日本語 テスト 123 4.5,6 ​﻿", "mixed.\nLine, ends. ", "ab'sc 's 't'", "a<|endoftext|>, <|endoftext|>### b<|endoftext|", "wörd### été... ꟑ ꟑ, ᄒ\u1161\u11ab e\u0301, ǆ ª º", "\x00 a\x00b", "z" * 5000, "word " * 3000]


@pytest.mark.parametrize("ids", [
    [], [7], [0, 2 ** 32 - 1], list(range(1024)), list(range(1025)), [5] * 3000,
    np.random.default_rng(1).integers(0, 49408, 5000).tolist(),
    (np.random.default_rng(2).integers(0, 60, 4000) + 2 ** 31 * (np.random.default_rng(3).random(4000) < .02)).astype(int).tolist()])
def test_blocks_round_trip(ids):
    data = tp.pack(np.array(ids, np.uint64))
    assert tp.unpack(data).tolist() == ids
    for a, b in ((0, 1), (1000, 1030), (len(ids) // 2, len(ids)), (3, 2)):
        assert tp.unpack(data, a, b).tolist() == ids[a:b]


def test_small_ids_with_outliers_take_few_bits():
    rng = np.random.default_rng(0)
    ids = rng.integers(100, 228, 1 << 14)
    ids[rng.random(len(ids)) < .01] = 4_000_000_000
    assert len(tp.pack(ids)) < len(ids) * 1.1


def test_words_give_the_tokenizers_ids():
    t = Tokenizer.from_file(PATH)
    with open(PATH, "rb") as f:
        got = tp.WordEncoder(f.read()).encode([(x or "").encode() for x in TEXTS])
    for text, coded in zip(TEXTS, got, strict=True):
        assert np.frombuffer(coded, "<u4").tolist() == t.encode(text or "", add_special_tokens=False).ids, text


def test_every_admitted_letter_before_closing_signs():
    t = Tokenizer.from_file(PATH)
    texts = ["tepesİ.", "Aİ, aİ! (İ) İİ...", "İ.", "İSTANBUL'DA, İZMİR'E GELDİ?"]
    texts += [w for c in map(chr, range(0x41, 0x250)) for w in (f"a{c}.", f"{c}!?", f"{c}b,", f"{c}'")]
    with open(PATH, "rb") as f:
        got = tp.WordEncoder(f.read()).encode([x.encode() for x in texts])
    for text, coded in zip(texts, got, strict=True):
        assert np.frombuffer(coded, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, text


def test_bounded_memo_gives_the_same(monkeypatch):
    with open(PATH, "rb") as f:
        whole = tp.WordEncoder(f.read())
    small = tp.WordEncoder(whole.tokenizer.to_str().encode())
    monkeypatch.setattr(tp, "MEMO_WORDS", 4)
    for x in TEXTS:
        b = [(x or "").encode()]
        assert small.encode(b) == whole.encode(b)


@pytest.mark.parametrize("record", [1 << 20, 50])
def test_round_trip_of_documents(spark, monkeypatch, record):
    monkeypatch.setattr(tp, "RECORD_IDS", record)
    rows = [(i * 37 % 101, t) for i, t in enumerate(TEXTS * 3)] + [(5, "again"), (5, "again"), (5, "other"), (None, "no number")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("x")).repartition(5)
    got = tp.round_trip(docs, PATH).collect()
    t = Tokenizer.from_file(PATH)
    want = []
    for d, text in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((d, len(ids), zlib.crc32(ids.tobytes())))
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=str) == sorted(want, key=str)
    at, last = 0, -1
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        assert last <= (-1 if r.doc_id is None else r.doc_id)
        at, last = at + r.n_tokens, -1 if r.doc_id is None else r.doc_id
    assert at == sum(w[1] for w in want)


def test_empty_table(spark):
    assert tp.round_trip(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
