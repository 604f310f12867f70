"""Registered queries of this package: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat, language, lm, merkle, mixing, nearest, neardup, passages, quality, repair, tokenfiles, urls

VOCABULARY = "byte_bpe_50k.json"
#: Its end-of-text id.
END_OF_TEXT = 50256


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return lm.contract(table(spark, folder, "documents"))


def op2_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents"), size=3, threshold=85)


def op3_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))


def op4_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.schedule_of(table(spark, folder, "documents"))


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.verdicts(table(spark, folder, "pages"))


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.predictions(table(spark, folder, "documents"))


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokenfiles.document_counts(table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY), END_OF_TEXT)


def op8_quality_ledger(spark: SparkSession, folder: str) -> DataFrame:
    return quality.digest(table(spark, folder, "documents"))


def op9_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.contract(table(spark, folder, "embeddings"))


def op10_chat_perspectives(spark: SparkSession, folder: str) -> DataFrame:
    return chat.renderings(table(spark, folder, "conversations"))


def op11_structure_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.audits(table(spark, folder, "conversations"))


def op12_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return passages.digest(table(spark, folder, "documents"))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.proofs(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_lm_score,
        op2_near_duplicates,
        op3_bpe_round_trip,
        op4_source_mix,
        op5_url_filter,
        op6_language,
        op7_token_counts,
        op8_quality_ledger,
        op9_nearest,
        op10_chat_perspectives,
        op11_structure_repair,
        op12_substring_dedup,
        op13_merkle_manifest,
    )
}
ORACLES: dict[str, str] = {
    "op5_url_filter": urls.SQL,
    "op10_chat_perspectives": chat.SQL,
    "op8_quality_ledger": quality.SQL,
    "op13_merkle_manifest": merkle.SQL,
}
