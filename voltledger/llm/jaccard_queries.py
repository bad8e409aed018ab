"""op3: all documents joined with their near copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltledger.llm import jaccard
from voltledger.llm.catalog import query, table


@query()
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "copy_id", "n_links")
