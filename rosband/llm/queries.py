"""Registered queries over the test tables: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rosband.llm import alignment, bpe, chat, langid, licenses, mixing, pii, quality, simhash, spotsigs, vectorcodes, warc, winnow

Query = Callable[[SparkSession, str], DataFrame]

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _table(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: spark.read.parquet(f"{sf_dir}/{name}.parquet")


documents = _table("documents")
pages = _table("pages")
conversations = _table("conversations")
embeddings = _table("embeddings")


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(documents(spark, sf_dir), VOCABULARY, public_tokenizers.PATTERN)


def op7_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(documents(spark, sf_dir))


def op2_spot_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.digest(documents(spark, sf_dir))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.digest(documents(spark, sf_dir))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(documents(spark, sf_dir))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(documents(spark, sf_dir))


def op6_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(pages(spark, sf_dir))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.digest(documents(spark, sf_dir))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(documents(spark, sf_dir))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(documents(spark, sf_dir))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.digest(documents(spark, sf_dir), left, public_tokenizers.PATTERN, right)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.digest(embeddings(spark, sf_dir))


def op13_chat_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.with_sample(conversations(spark, sf_dir), -7, "\\### Assistant: </turn> ok")
    return chat.digest(turns, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_bpe_round_trip,
        op2_spot_fingerprints,
        op3_language_id,
        op4_quality_rules,
        op5_license_scan,
        op6_warc_derivatives,
        op7_simhash_components,
        op8_line_dedup,
        op9_source_mix,
        op10_personal_data,
        op11_token_alignment,
        op12_vector_codes,
        op13_chat_masks,
    )
}
