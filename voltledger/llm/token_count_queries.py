"""op6: tokens of every line of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltledger.llm import token_counts
from voltledger.llm.catalog import query, table


@query()
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_tokens(table(spark, sf_dir, "documents"), rule="largest")
