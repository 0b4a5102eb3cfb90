import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from eventlake.llm import token_pack, toxicity
from eventlake.session import scratch_path
from tests.llm.test_decontaminate import brute as brute_leaks
from tests.llm.test_mixing import fill, words
from tests.llm.test_simhash import brute_components, brute_fingerprint

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def sf_dir(spark):
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("aeioulnrstdmkh"), rng.integers(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    bench = [(i, text(14)) for i in range(4)]
    docs, labels = [], []
    for i in range(260):
        t = text(int(rng.integers(20, 50)))
        if i % 6 == 0:
            for _ in range(3):
                t += " " + rng.choice(["you scum", "zorgfal", "idiot", "zorgfen"]) + " " + word()
        if i % 17 == 1:
            t += " " + bench[i % 4][1].upper() + ". " + text(10)
        if i % 2 == 0:
            labels.append((i, 1, int(i % 6 == 0)))
        docs.append((i, t, "en", f"s{i % 3}" if i % 5 else None, None))
    docs += [(1000 + i, docs[7][1], "en", "s1", 3) for i in range(8)]
    docs += [(8, docs[8][1], "en", "s0", 1), (9, docs[9][1] + " more", "de", "s0", 1), (None, None, None, None, None), (2000, "", "en", "s2", 0),
             (2001, text(3000), "en", "s1", None)]
    path = scratch_path(spark, "pipeline-in")
    for name, rows, schema in (("documents", docs, SCHEMA), ("benchmark", bench, "item_id long, text string"),
                               ("labels", labels, "doc_id long, quality int, toxic int")):
        spark.createDataFrame(rows, schema).withColumn("_fp", F.lit("extra")).repartition(3).write.parquet(f"{path}/{name}.parquet")
    return path


def rows_of(df):
    return Counter(map(tuple, df.collect()))


def test_stages_do_what_their_operators_say(spark, sf_dir):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "simhash", "decontamination", "mixing", "token_ids"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").cache()
    columns, kept = docs.columns, rows_of(docs)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    frames = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir).cache()
        frames.append(docs)
    for df in frames[:-1]:
        assert df.columns == columns

    grammar = toxicity.learn(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels)
    kept = Counter({r: n for r, n in kept.items() if grammar.scored([r[1] or ""])[0] < 0.5})
    assert rows_of(frames[0]) == kept
    toxic = {i for i in range(260) if i % 6 == 0}
    assert not toxic & {r[0] for r in kept} and len(kept) > 180

    every = sorted(kept.elements(), key=str)
    component = brute_components(list(range(len(every))), [brute_fingerprint(r[1]) for r in every])
    groups = defaultdict(list)
    for r, c in zip(every, component, strict=True):
        groups[c].append(r)
    kept = Counter(min(g, key=lambda r: ((r[0] is None, r[0]), (r[1] is not None, r[1]))) for g in groups.values())
    got = rows_of(frames[1])
    assert Counter(r[:2] for r in got.elements()) == Counter(r[:2] for r in kept.elements())
    kept = got

    bad = {d for d, *_ in brute_leaks([(r[0], r[1]) for r in kept], [tuple(r)[:2] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()])}
    assert len(bad) >= 8
    kept = Counter({r: n for r, n in kept.items() if r[0] not in bad})
    assert rows_of(frames[2]) == kept

    sizes, members = Counter(), defaultdict(list)
    for r in kept.elements():
        sizes[r[3]] += words(r[1])
        members[r[3]].append(r)
    want, target = Counter(), fill(sizes)
    for s, own in members.items():
        whole, reached = (int(target[s] // sizes[s]) if sizes[s] else 0), 0
        for r in sorted(own, key=lambda r: hashlib.md5(f"7:{'null' if r[0] is None else r[0]}".encode()).hexdigest()):
            reached += words(r[1])
            want[r] += min(2, whole + (reached - words(r[1]) / 2 <= target[s] - whole * sizes[s])) if sizes[s] else 0
    assert rows_of(frames[3]) == +want

    t = Tokenizer.from_file(public_tokenizers.path(token_pack.TOKENIZER))
    lengths = Counter((r[0], len(t.encode(r[1] or "", add_special_tokens=False).ids) + 1) for r in want.elements())
    assert Counter((r.doc_id, r.n_tokens) for r in frames[4].collect()) == lengths


def test_run_applies_all_stages(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    rows = sorted(out.collect(), key=lambda r: r.start)
    assert rows and sum(r.n_tokens for r in rows) == rows[-1].start + rows[-1].n_tokens
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect()), key=str) == sorted(map(tuple, rows), key=str)


def test_empty_tables(spark):
    path = scratch_path(spark, "pipeline-empty")
    for name, schema in (("documents", SCHEMA), ("benchmark", "item_id long, text string"), ("labels", "doc_id long, quality int, toxic int")):
        spark.createDataFrame([], schema).write.parquet(f"{path}/{name}.parquet")
    assert corpus_pipeline.run(spark, path).count() == 0
