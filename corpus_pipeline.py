"""A corpus pipeline of training-data operators over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept.
``run`` writes every stage's rows as Parquet to the shared scratch folder and rereads
them for the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from eventlake.llm import decontaminate, mixing, simhash, token_pack, toxicity
from eventlake.llm.common import read_table, written


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return simhash.keep_one(docs)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar rejects go."""
    return toxicity.accepted(docs, read_table(spark, sf_dir, "labels"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it."""
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token ids written to shards; per document what the files hold of it."""
    return token_pack.round_trip(docs, public_tokenizers.path(token_pack.TOKENIZER))


STAGES = [("toxicity", without_toxic), ("simhash", near_duplicates), ("decontamination", without_benchmark),
          ("mixing", mixed_sources), ("token_ids", token_ids)]

# The fingerprints are seeded XXH64 hashes, which SQL engines do not offer: None. The stages
# are tested against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
