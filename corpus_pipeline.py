"""The corpus pipeline over ``documents``, and the queries of the operators it is made of.

Each stage gets what its predecessor kept, written as Parquet and read again.  Quality and
toxicity models are trained on the stage's own documents, from the labels outside the held-out
folds.  All stages but the last return the columns of ``documents``; the last returns the pieces
of packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltledger.llm import decontamination, jaccard, packing, quality, toxicity
from voltledger.llm.catalog import query, table
from voltledger.llm.queries import QUERIES, SQL
from voltledger.session import stage


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model accepts."""
    return quality.accepted(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model accepts."""
    return toxicity.accepted(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.first_of_each_class(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with the benchmark."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences."""
    return packing.pack(docs, added_tokens=True)


STAGES = [
    ("quality", keep_good),
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("packing", pack),
]
# Trained models and a tokenizer: no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs


@query(ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)


__all__ = ["ORACLE_SQL", "QUERIES", "SQL", "STAGES", "run"]
