"""A corpus from raw documents to packed sequences; each stage is written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from storelens.llm import decontamination, ngram_join, packing, quality, repeats
from storelens.llm.frames import read_table, stored

# Passages of over 50 words are to go, which short words make this long; below it lie the strings
# that texts share by chance. The trigger is as much shorter, so that phrases stay as long.
PASSAGE_BYTES, TRIGGER_BYTES = 250, 64

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep_good(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id."""
    return ngram_join.one_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the long passages that occur elsewhere too."""
    return repeats.without_repeats(docs, length=PASSAGE_BYTES, trigger=TRIGGER_BYTES)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by a benchmark."""
    return decontamination.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in the training sequences."""
    return packing.digest(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard", one_of_each_group),
    ("suffix_dedup", without_repeats),
    ("benchmark_decontamination", without_benchmarks),
    ("best_fit_packing", packed),
]
ORACLE_SQL = None  # tokenizing and packing are beyond SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
