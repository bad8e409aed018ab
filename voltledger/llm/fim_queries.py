"""op13: all documents transformed, with digests of the outputs and of the texts rebuilt from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltledger.llm import fim
from voltledger.llm.catalog import query, table

_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
  sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
h AS (SELECT *, ('0x' || x[1:8])::BIGINT % (n + 1) AS a, ('0x' || x[9:16])::BIGINT % (n + 1) AS b,
  ('0x' || x[17:24])::BIGINT % 100 AS c, ('0x' || x[25:32])::BIGINT % 100 AS e FROM d),
f AS (SELECT *, least(a, b) AS p, greatest(a, b) AS q,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 90 THEN 'plain'
       WHEN e < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
o AS (SELECT *, substr(t, 1, p) AS pre, substr(t, p + 1, q - p) AS mid, substr(t, q + 1) AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN p END AS prefix_chars, CASE WHEN form <> 'plain' THEN q - p END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM o
"""


@query(_SQL)
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.transform(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fim.restored(), 256).alias("restored_sha256"))
