"""The registered queries of the numbered operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from modelweave.llm import byte_pairs, decontamination, hard_negatives, languages, licenses, near_duplicates, neighbours, packing, pages, prefix_tries, sharding, substrings, toxicity
from modelweave.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_digest(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def op2_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract_main_text(read_table(spark, folder, "pages"))


def op3_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, folder, "documents"))


def op8_languages(spark: SparkSession, folder: str) -> DataFrame:
    return languages.language_digest(read_table(spark, folder, "documents"))


def op9_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contamination_digest(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


def op4_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, folder, "documents"))


def op5_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicate_digest(read_table(spark, folder, "documents"))


def op6_pack(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read_table(spark, folder, "documents"))


def op7_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.substring_digest(read_table(spark, folder, "documents"))


def op10_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.neighbour_digest(read_table(spark, folder, "embeddings"))


def op11_byte_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return byte_pairs.encoding_digest(read_table(spark, folder, "documents"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_tries.trie_digest(read_table(spark, folder, "conversations"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.hard_negative_digest(read_table(spark, folder, "embeddings"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_toxicity, op2_main_text, op3_licenses, op4_shards, op5_near_duplicates, op6_pack, op7_substrings, op8_languages, op9_decontaminate, op10_neighbours, op11_byte_pairs, op12_prefix_trie, op13_hard_negatives)}
SQL: dict[str, str] = {
    "op3_licenses": licenses.SQL,
    "op5_near_duplicates": near_duplicates.SQL,
    "op7_substrings": substrings.SQL,
    "op9_decontaminate": decontamination.SQL,
    "op12_prefix_trie": prefix_tries.SQL,
    "op13_hard_negatives": hard_negatives.SQL,
}
