"""op1: all pages archived and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltledger.llm import warc
from voltledger.llm.catalog import query, table

# Base 32 from hex: five hex digits are four letters.
_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS x FROM p),
t AS (SELECT *, min(page_id) OVER (PARTITION BY x) AS first,
  row_number() OVER (PARTITION BY x ORDER BY page_id NULLS LAST) AS k FROM d)
SELECT page_id, n AS payload_bytes,
  array_to_string([array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(x, 5 * g + 1, 5))::INT >> s) & 31) + 1)::INT, 1) FOR s IN [15, 10, 5, 0]], '') FOR g IN range(8)], '') AS payload_digest,
  CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN k > 1 THEN first END AS refers_to
FROM t
"""


@query(_SQL)
def op1_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_index(table(spark, sf_dir, "pages")).drop("url")
