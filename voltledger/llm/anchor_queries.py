"""op12: codes of all vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltledger.llm import codes
from voltledger.llm.catalog import query, table


def _sql() -> str:
    """Six rounds written out: distances of all parts to all entries, nearest entry, means rounded down."""
    steps = []
    for i in range(7):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT r, part, x, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM
  (SELECT p.r, p.part, p.x, c.entry, list_sum([(g[1] - g[2]) * (g[1] - g[2]) FOR g IN list_zip(p.x, c.x)])::BIGINT AS d FROM p JOIN c{i} c ON p.part = c.part)
  GROUP BY r, part, x)""")
        if i < 6:
            steps.append(f"""m{i} AS (SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS x FROM (SELECT part, entry, pos, sum(v)::BIGINT AS s, count(*) AS n FROM
  (SELECT part, entry, unnest(x) AS v, generate_subscripts(x, 1) AS pos FROM a{i}) GROUP BY part, entry, pos) GROUP BY part, entry),
c{i + 1} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m USING (part, entry))""")
    return f"""
WITH v AS (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, [floor(4096 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS MATERIALIZED (SELECT r, part, e[part * (len(e) // 8) + 1 : (part + 1) * (len(e) // 8)] AS x FROM v, range(8) t(part)),
c0 AS (SELECT part, r - 1 AS entry, x FROM p WHERE r <= 16),
{', '.join(steps)},
o AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a6 GROUP BY r),
h AS (SELECT sha256(string_agg(x, ',' ORDER BY part, entry)) AS codebooks_sha256 FROM (SELECT part, entry, array_to_string(x, ',') AS x FROM c6))
SELECT v.vec_id, o.code, o.error, o.error::VARCHAR AS error_digits, sum(o.error) OVER (PARTITION BY v.label)::BIGINT AS label_error, h.codebooks_sha256
FROM v JOIN o USING (r), h
"""


@query(_sql())
def op12_anchor_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings"))
