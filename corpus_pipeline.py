"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketloom.llm.common import ship, store, table
from marketloom.llm.line_dedup import without_repeated_lines
from marketloom.llm.near_dedup import one_of_each_group
from marketloom.llm.packing import pack
from marketloom.llm.quality import keep_good
from marketloom.llm.queries import TOKENIZER, tokenizer_path
from marketloom.llm.substring_dedup import without_repeats


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    ship(spark)
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines go that are near-equal to an earlier one. A document that loses all its lines stays, empty."""
    ship(spark)
    return without_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays; emptied documents are one group."""
    ship(spark)
    return one_of_each_group(docs, copies=True)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words go that lie in a passage which occurs elsewhere too."""
    ship(spark)
    return without_repeats(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Everything that is left, packed into sequences with their token ids."""
    ship(spark)
    return pack(docs, tokenizer_path(TOKENIZER))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", best_fit_packing),
]

# The classifier and the packing are not expressible in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is stored before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
