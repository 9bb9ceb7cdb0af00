"""Corpus pipeline over ``documents``: five stages, each written as Parquet and read by the next.

1. ``quality``: rows that the quality rules reject go, lines above the limit of their host go (operator 4);
2. ``lines``: later repeats of 50 words or more go: runs of equal lines, found by winnowed line hashes and extended both
   ways, then by words the passages that begin or end inside a line (operator 8);
3. ``near_duplicates``: one row of every SimHash component stays (operator 7);
4. ``mixture``: sources are mixed to ``mixing.WEIGHTS``, 80 % of the tokens in one epoch (operator 9);
5. ``tokens``: whole texts are encoded by byte-level BPE and decoded again (operator 1).

All but the last return the columns of ``documents``.  The defined cases (nulls, empty and long texts,
repeated rows, empty tables, extra columns) are those of the operators.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosband.llm import bpe, mixing, quality, simhash, winnow
from rosband.llm.common import written
from rosband.operators.joins import Datasets

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs)


def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return winnow.dedup_passages(docs)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, shingle=3, max_bits=3)


def mixture_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One epoch: documents that were just deduplicated are not repeated here."""
    return mixing.mix(docs, epochs=1, weights=mixing.WEIGHTS)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, ids`` (4 bytes each, little-endian), SHA-256 of the ids and of the bytes
    they decode to."""
    docs = docs.select("doc_id", "lang", "source", "text")
    return bpe.encode(docs, VOCABULARY, public_tokenizers.PATTERN, decoded="decoded").select(
        "doc_id",
        "lang",
        "source",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", quality_stage),
    ("lines", lines_stage),
    ("near_duplicates", near_duplicates_stage),
    ("mixture", mixture_stage),
    ("tokens", tokens_stage),
]

#: Winnowing, components and BPE are beyond SQL: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows.  What a stage wrote on its way is deleted once its result is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        own = Datasets(spark)
        with own.active():
            out = stage(spark, docs, sf_dir)
        docs = written(out)
        own.close()
    return STAGES[-1][1](spark, docs, sf_dir)
