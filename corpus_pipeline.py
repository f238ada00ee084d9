"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before kept, and its result is written as
Parquet and read again before the next one. All but the last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyworks.llm import chosen_path, decontamination, mil, packing, quality_rules
from tallyworks.llm.staging import ship_package, staged, table


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches 0.3, by a model of the labelled ones."""
    return mil.keep_good(docs, mil.fit(docs, table(spark, sf_dir, "labels")))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    ship_package(spark)
    return quality_rules.keep_good(docs)


def remove_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies."""
    ship_package(spark)
    return chosen_path.keep_one_each(docs)


def remove_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, edited or not."""
    leaks = decontamination.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return decontamination.drop_leaks(docs, leaks)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 1024 tokens."""
    ship_package(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), keep_white=True, end_id=0,
                        targets=packing.EQUAL)


STAGES = [
    ("quality classifier", classify_quality),
    ("quality rules", apply_rules),
    ("n-gram Jaccard join", remove_copies),
    ("benchmark decontamination", remove_benchmarks),
    ("packing", pack_sequences),
]

# Fitted networks, sampled paths and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
