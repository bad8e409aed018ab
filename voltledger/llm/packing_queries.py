"""op8: all documents packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltledger.llm import packing
from voltledger.llm.catalog import query, table


@query()
def op8_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), added_tokens=True)
