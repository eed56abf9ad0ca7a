"""Corpus pipeline: language, near copies, benchmark passages, secrets, packing.

Every stage takes (spark, docs, sf_dir) and is written as Parquet before the next one reads it. All but the last return the
columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from flowsift.llm import langid, secrets
from flowsift.llm.decontaminate import drop_leaks
from flowsift.llm.minhash import near_duplicates
from flowsift.llm.packing import Limits, pack_sequences
from flowsift.session import materialize

#: Texts whose best language has a smaller mean probability over their bytes belong to none.
LEAST_LANGUAGE_SCORE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, texts that look more like none of the learnt languages than like one, and texts without a clear one go."""
    return langid.keep_identified(docs, langid.train_language_model(docs, reject=True), LEAST_LANGUAGE_SCORE)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (shingles of five words, similarity 0.8) the document with the smallest id stays.

    Rows without an id stay; rows repeated under one id stay or go together.
    """
    gone = near_duplicates(docs, k=5, percent=80).where("not kept and doc_id is not null").select("doc_id").distinct()
    return docs.join(gone.hint("merge"), "doc_id", "left_anti").select(docs.columns)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of `benchmark` go."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return secrets.redact_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents, in sequences of at most 4096 tokens and 64 segments."""
    return pack_sequences(docs, public_tokenizers.path("word_bpe_49k.json"), limits=Limits(tokens=4096, segments=64, loss=4096))


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("benchmark", drop_benchmark_passages),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: A trained network decides in the first stage, which SQL cannot express; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
