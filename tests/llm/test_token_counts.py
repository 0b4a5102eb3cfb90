from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventlake.llm import token_counts as tc

PATH = public_tokenizers.path(tc.TOKENIZER)
TEXTS = [None, "", " ", "\n", "  a", "a  b   c\n\n d \n", "Hello, World. it's o'clock we'll'd  ", "a\x1c b \x1cc\x85 d　e  f",
         "İstanbul ΣΑΣ ς straße é é ﬁ ½ ²", "<|endoftext|> a<|endoftext|> <|endoftext|>b", "wow!!, yes., no,. a., é, (x) x: y;",
         "日本語 テスト 123 4.5,6 ​﻿ ꟑ ꟑ.", "\t tab\ttab \t\n x", "ends with line\n", "z" * 3000, "word " * 3000, "the " * 70000 + "end", " \n \n a", "a  b  c"]


@pytest.fixture(scope="module")
def pre():
    with open(PATH, "rb") as f:
        return tc.PreTokens(f.read())


def test_cuts_give_the_librarys_pretokens(pre):
    texts = [t or "" for t in TEXTS if "<|" not in (t or "")]
    index, cuts = tc.cuts_of([t.encode() for t in texts], pre)
    apart = [*map(pre.apart, index)]
    for text, own in zip(texts, cuts, strict=True):
        got = [t for c in own for t in apart[c]]
        assert b"".join(got) == text.encode()
        assert got == [bytes(map(pre.letters.__getitem__, p)) for p, _ in pre.splitter.pre_tokenize_str(text)], text[:50]
        assert set(got) <= tc.pretokens_of([text.encode()], pre)
    everything = [(t or "").encode() for t in TEXTS]
    assert set(tc.Chunk(everything, pre).tokens) >= {t for x in everything for t in tc.Chunk([x], pre).tokens if tc.Chunk([x], pre).freq.any()}


def test_entries_round_trip(pre):
    chunk = tc.Chunk([b"x", b"the " * 2000 + b"x x", b"", b"y x"], pre)
    count, where, freq = tc.entries(chunk.rows())
    got = Counter()
    for t, w, f in zip(np.repeat(np.arange(len(count)), count), where, freq, strict=True):
        got[chunk.tokens[t], w] += f
    assert got == {(b"x", 0): 1, (b"the", 1): 1, (b" the", 1): 1999, (b" x", 1): 2, (b"y", 3): 1, (b" x", 3): 1}


@pytest.mark.parametrize("held", [40, tc.HELD_SUMS])
def test_partial_sums_over_thousands_of_chunks(monkeypatch, held):
    monkeypatch.setattr(tc, "HELD_SUMS", held)
    rng, want, batches = np.random.default_rng(5), Counter(), []
    numbers = (np.arange(3000) % 41 << 32 | np.arange(3000)).tolist()
    for _ in range(6):
        rows = []
        for c in rng.choice(numbers, 500).tolist():
            places, freq, pieces = rng.choice(tc.CHUNK_DOCS, 3, replace=False), rng.integers(1, 200, 3), int(rng.integers(1, 9))
            rows.append((2, c, places.astype("<u2").tobytes() + freq.astype("u1").tobytes(), pieces))
            want.update({(c, int(p)): int(f) * pieces for p, f in zip(places, freq, strict=True)})
        rows.append((numbers[0] << 1 | 1, numbers[0], b"header", None))
        batches.append(pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.binary(), pa.int32()), strict=True)],
                                                  names=["key", "chunk", "entries", "pieces"]))
    got, heads = Counter(), 0
    for batch in tc._partial_sums(iter(batches)):
        for r in batch.to_pylist():
            heads += r["header"]
            for place, total in np.frombuffer(b"" if r["header"] else r["sums"], tc._SUM).tolist():
                got[r["chunk"], place] += total
    assert got == want and heads == 6


@pytest.mark.parametrize("parts", [1, 7])
def test_matches_the_library(spark, parts):
    rows = list(enumerate(TEXTS)) + [(4, TEXTS[4]), (4, "other"), (None, "no number")] + [(100 + i, f"some words {i} " * (i % 7)) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("token", F.lit(1)).repartition(parts)
    got = sorted((tuple(r) for r in tc.count_tokens(docs, PATH, 100).collect()), key=str)
    t = Tokenizer.from_file(PATH)
    n = [len(t.encode(x or "", add_special_tokens=False).ids) for _, x in rows]
    assert got == sorted(((d, len((x or "").encode()), k, k > 100) for (d, x), k in zip(rows, n, strict=True)), key=str)


def test_empty_table_and_other_files(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert tc.count_tokens(docs, PATH).count() == 0
    with pytest.raises(ValueError):
        tc.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
