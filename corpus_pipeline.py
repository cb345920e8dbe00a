"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

Every stage but the last returns the columns of ``documents``. Null and empty
texts pass all filters; repeated rows are judged row by row, except that rows
with one id stay or go together in the near-duplicate stage. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from modelweave.llm import decontamination, near_duplicates, packing, substrings, toxicity
from modelweave.llm.languages import held_out
from modelweave.plans.workspace import discard, made_here, store
from modelweave.sources.tables import read_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# a learned model and a packing by linear program: not expressible in SQL
ORACLE_SQL: str | None = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of the labels calls toxic go; held-out labels teach nothing."""
    labels = read_table(spark, sf_dir, "labels").filter(~held_out())
    return toxicity.drop_toxic(docs, toxicity.learn(docs.filter(~held_out()), labels))


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts that share four fifths of their five-word shingles the smallest id stays."""
    return near_duplicates.keep_one_of_each(docs)


def drop_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of windows of 20 that also stand earlier go, the rest of the text and the document stay."""
    return substrings.remove_repeats(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which at least a twentieth stands in windows of the benchmark go."""
    return decontamination.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near-duplicates", keep_one_copy),
    ("repeated substrings", drop_repeated_spans),
    ("benchmark decontamination", drop_benchmark),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents.

    What a stage stored, and the table it read, are removed once its own table
    is written. A run touches its own folders only; the last table stays with
    the result, which reads it.
    """
    docs = read_table(spark, sf_dir, "documents")
    read: list[str] = []
    for _, stage in STAGES[:-1]:
        with made_here() as folders:
            docs = store(stage(spark, docs, sf_dir), "stage")
        own = folders.pop()
        discard(spark, [*folders, *read])
        read = [own]
    return STAGES[-1][1](spark, docs, sf_dir)
