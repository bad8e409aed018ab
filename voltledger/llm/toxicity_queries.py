"""op7: toxicity of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltledger.llm import toxicity
from voltledger.llm.catalog import query, table
from voltledger.llm.texts import remainder


@query()
def op7_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        F.col("toxic_score").alias("score"), (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"))
