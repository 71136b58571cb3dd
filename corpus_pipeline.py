"""A corpus pipeline of five stages over the ``documents`` table.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes every stage's result as Parquet and reads it again as the next one's
``docs``, so a stage is never computed twice and a lost executor costs its own
tasks only.

Edge cases are those of the operators: null and empty texts are rejected by
the first stage (no language); an empty table runs through all stages.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import language, line_dedup, mixing, packing, simhash
from strata.llm.common import n_chars_after, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the labelled languages stay; those that are likelier
    noise, and those without letters, go."""
    return language.accepted(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that five documents hold stay only in the one of the largest id;
    ``n_chars`` follows the text."""
    return n_chars_after(line_dedup.dedup_documents(docs), docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: that of the smallest id."""
    return simhash.representatives(docs, shingle=3, radius=2)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of the mixed documents; repetitions of a document share no bin."""
    return packing.pack(docs, cluster=F.col("doc_id"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", simhash_stage),
    ("source_mixing", mixing_stage),
    ("best_fit_packing", packing_stage),
]

#: The language model and SimHash components are not SQL; tests/llm holds each
#: stage against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
