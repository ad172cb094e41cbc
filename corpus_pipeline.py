"""A corpus pipeline of five stages over documents: each takes what its predecessor kept, as reread from Parquet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weftline.llm import op2_mixing, op4_suffixes, op7_toxicity, op8_chosen_path, op10_packing
from weftline.llm.common import table, written


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models reject go. Labels are looked up for the documents at hand."""
    return op7_toxicity.kept(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id."""
    return op8_chosen_path.deduplicated(docs)


def suffixes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Text that an earlier document has too is cut; every document stays, with the text that is left."""
    return op4_suffixes.deduplicated(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled by probabilities that rake source, language and topic to their targets."""
    return op2_mixing.sampled(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in the training sequences."""
    return op10_packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("suffixes", suffixes),
    ("mixing", mixing),
    ("packing", packing),
]

#: The classifier and the tokenizer are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
