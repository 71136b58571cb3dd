"""The queries of this subpackage, one for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    embedding_dedup, language, line_dedup, merkle, mixing, packing, prefix_trie, simhash, substring_dedup, syncmers, token_files, toxicity,
    url_filters,
)
from strata.llm.common import table, written
from strata.session import scratch_path


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filters.evaluate(url_filters.captures_of(pages), written(url_filters.entries_of(pages), "url-entries"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_digest(table(spark, sf_dir, "documents")).drop("keep")


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.removal_digest(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.edited_digest(table(spark, sf_dir, "documents"))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = scratch_path(spark, "llm-token-files")
    token_files.write(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_digest(spark, folder)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_url_filters": op2_url_filters,
    "op3_line_dedup": op3_line_dedup,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op5_simhash": op5_simhash,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_language_id": op8_language_id,
    "op9_source_mixing": op9_source_mixing,
    "op10_syncmer_fingerprints": op10_syncmer_fingerprints,
    "op11_token_files": op11_token_files,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_prefix_trie": op13_prefix_trie,
}

#: DuckDB SQL where it can express the query's rows.
ORACLE_SQL: dict[str, str] = {
    "op2_url_filters": url_filters.SQL,
    "op3_line_dedup": line_dedup.SQL,
    "op4_embedding_near_dedup": embedding_dedup.SQL,
    "op7_substring_dedup": substring_dedup.SQL,
    "op9_source_mixing": mixing.SQL,
    "op12_merkle_manifest": merkle.SQL,
    "op13_prefix_trie": prefix_trie.SQL,
}
