"""Documents to packed training sequences, stage by stage; every stage is written as Parquet and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from daygrid.llm import exact_dedup, langid, ngram_join, packing, pii
from daygrid.llm.common import prepare, stage
from daygrid.llm.queries import BYTE_RANKS, BYTE_SPECIALS


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language, all where no lang is given; lang is filled in by the prediction where it is null."""
    prepare(spark)
    return langid.keep_known(docs, langid.fit(docs))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_last(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return ngram_join.keep_first(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack(docs, BYTE_RANKS, public_tokenizers.PATTERN, BYTE_SPECIALS)


STAGES = [
    ("language", by_language),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("pii", without_personal_data),
    ("packing", packed),
]

#: A trained network and a tokenizer decide rows: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    name, last = STAGES[-1]
    return stage(last(spark, docs, sf_dir), f"pipeline-{name}")
