"""A training corpus from raw documents: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from hazardspark.llm import bpe, mixing, pii, simhash, toxicity
from hazardspark.llm.common import table
from hazardspark.session import fresh_dir


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain rejects go."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group stays; links are pairs whose five-word shingles have a Jaccard similarity of 0.8."""
    return simhash.keep_one_similar(docs, size=5, percent=80)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced in the texts."""
    return pii.redact(docs, pii.fit(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled so that source, language and topic meet their target weights."""
    return mixing.mix(docs).where("m_kept").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its ids, and whether they decode to its text."""
    return bpe.with_ids(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", remove_toxic),
    ("simhash_near_duplicates", remove_near_duplicates),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
    ("byte_level_bpe", encode),
]

#: No SQL: the stages train models. tests/llm hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what is between stages lies in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
