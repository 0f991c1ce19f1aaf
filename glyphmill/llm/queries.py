"""The registered queries of the training-data operators: production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, media, neardup, packing, quality, secrets, sharding, suffixtree, tokencount, toxicity
from .common import table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), WORD_BPE)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), BYTE_BPE)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), WORD_BPE)


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixtree.score(table(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.text_media(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_toxicity": op2_toxicity,
    "op3_packing": op3_packing,
    "op4_token_counts": op4_token_counts,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_suffix_tree": op6_suffix_tree,
    "op7_secrets": op7_secrets,
    "op8_media": op8_media,
    "op9_quality": op9_quality,
    "op10_sharding": op10_sharding,
}

ORACLE_SQL: dict[str, str] = {
    "op10_sharding": sharding.ORACLE_SQL,
}
