"""op5: the language of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltledger.llm import language
from voltledger.llm.catalog import query, table
from voltledger.llm.texts import remainder


@query()
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.train(docs))
    return found.withColumn("held_out", F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)))
