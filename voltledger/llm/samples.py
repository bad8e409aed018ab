"""Bounded samples of labelled documents for fitting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltledger.llm.texts import remainder
from voltledger.session import stage


def labelled(labels: DataFrame, label: str, folds: int, held_out: int) -> DataFrame:
    """(doc_id, label) once per document outside the held-out fold; of clashing labels the larger."""
    rows = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & (remainder("doc_id", folds) != held_out))
    return rows.groupBy("doc_id").agg(F.max("label").alias("label"))


def smallest_by_hash(rows: DataFrame, n: int) -> DataFrame:
    """At most n rows, the same ones in every run: those whose ids have the smallest hashes."""
    return stage(rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n), "fit-sample")
