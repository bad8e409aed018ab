"""op9: the ten best inner products of every hundredth vector."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltledger.llm import mtree
from voltledger.llm.catalog import query, table

_SQL = """
WITH v AS (SELECT vec_id, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum([p[1] * p[2] FOR p IN list_zip(q.e, c.e)])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 10
"""


@query(_SQL)
def op9_mtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = mtree.to_integers(table(spark, sf_dir, "embeddings"))
    return mtree.top_k(vectors, vectors.where("vec_id % 100 = 0"), k=10)
