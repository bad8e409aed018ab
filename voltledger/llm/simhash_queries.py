"""op11: every document's fingerprint and component."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltledger.llm import simhash
from voltledger.llm.catalog import query, table


@query()
def op11_simhash_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))
