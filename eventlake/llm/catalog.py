"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from eventlake.llm import alignment, chat, decontaminate, mixing, periodic, pii, quality_knn, quality_rules, sharding, simhash, token_counts, token_pack, toxicity
from eventlake.llm.common import read_table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op2_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_knn.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(read_table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read_table(spark, sf_dir, "documents"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted(read_table(spark, sf_dir, "conversations"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_token_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_pack.round_trip(read_table(spark, sf_dir, "documents"), public_tokenizers.path(token_pack.TOKENIZER))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path(token_counts.TOKENIZER))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read_table(spark, sf_dir, "documents"))


def with_planted_cycle(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words that the contract of op12 derives: every tenth document or so repeats a
    stretch of its own to the end. A null doc_id has no decimal and keeps its words."""
    h = zlib.crc32(b"%d" % doc_id) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * (1 + (n - a) // p))[:n - a]


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.collapse(read_table(spark, sf_dir, "documents"), with_planted_cycle)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read_table(spark, sf_dir, "documents"), public_tokenizers.path(alignment.A_FILE), public_tokenizers.path(alignment.B_FILE))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_simhash, op2_quality_knn, op3_decontaminate, op4_pii, op5_mixing, op6_chat, op7_quality_rules,
                            op8_toxicity, op9_token_pack, op10_token_counts, op11_sharding, op12_periodic, op13_alignment)}
ORACLES: dict[str, str] = {"op5_mixing": mixing.ORACLE, "op6_chat": chat.ORACLE}
