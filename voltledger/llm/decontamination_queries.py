"""op10: documents against the benchmark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltledger.llm import decontamination
from voltledger.llm.catalog import query, table

_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
          r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
_SQL = f"""
WITH item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, len, array_to_string(w[i:i + len - 1], ' ') AS x
  FROM (SELECT item_id, w, least(len(w), 10) AS len, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
        FROM item WHERE len(w) > 0)),
doc AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
spot AS (SELECT r, i, l, array_to_string(w[i:i + l - 1], ' ') AS x
  FROM (SELECT r, w, l, unnest(range(1, len(w) - l + 2)) AS i
        FROM doc, (SELECT DISTINCT len AS l FROM win) WHERE len(w) >= l)),
hit AS (SELECT r, i, l, item_id FROM spot JOIN win USING (x) WHERE l = len),
cover AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + l)) AS p FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(k, ',' ORDER BY k) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS k FROM hit) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(cover.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(cover.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN cover USING (r) LEFT JOIN items USING (r)
"""


@query(_SQL)
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
