"""Read-only statements: what they may reach is decided on their plans."""

import pytest
from pyspark.sql import functions as F

from voltledger.operators import guard, serving


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    rows = spark.range(6).select("id", F.concat(F.lit("p"), F.col("id") % 2).alias("counterparty"), (F.col("id") * 1.5).alias("x"),
                                 F.array(F.lit(1), F.lit(2)).alias("a"), F.lit("2026-01-02 03:04:05").cast("timestamp").alias("ts"))
    rows.write.parquet(f"{root}/3_gold/counterparty_risk")
    rows.write.parquet(f"{root}/3_gold/trades_pnl")
    spark.range(2).createOrReplaceGlobalTempView("shared_rows")
    spark.range(2).write.mode("overwrite").saveAsTable("secret_rows", path=f"{root}/elsewhere")
    yield root
    spark.sql("DROP TABLE secret_rows")
    spark.catalog.dropGlobalTempView("shared_rows")


REFUSED = [
    "SELECT count(*) FROM IDENTIFIER('secret_rows')", "SELECT count(*) FROM IDENTIFIER('global_temp.shared_rows')",
    "SELECT IDENTIFIER('ref'||'lect')('java.lang.System', 'getProperty', 'user.dir')",
    "SELECT * FROM range(100000000000)", "SELECT count(*) FROM range(9) a, counterparty_risk",
    "SELECT * FROM counterparty_risk WHERE id IN (SELECT id FROM secret_rows)", "TABLE secret_rows",
    "SELECT id FROM counterparty_risk WHERE EXISTS (SELECT IDENTIFIER('refl' || 'ect')('java.lang.Math', 'abs', 1))",
    "WITH w AS (SELECT * FROM IDENTIFIER('secret_' || 'rows')) SELECT * FROM w",
    "SELECT * FROM (SELECT * FROM counterparty_risk) JOIN LATERAL (SELECT * FROM secret_rows)",
    "SELECT explode(sequence(1, 100000000000)) FROM counterparty_risk", "SELECT repeat(counterparty, 1000000000) FROM counterparty_risk",
    "WITH RECURSIVE r AS (SELECT 1 AS n UNION ALL SELECT n + 1 FROM r) SELECT * FROM r",
    "SELECT input_file_name() FROM counterparty_risk", "SELECT try_reflect('java.lang.Math', 'abs', 1)", "SELECT java_method('java.util.UUID', 'randomUUID')",
    "SELECT /*+ REPARTITION(1000000) */ * FROM counterparty_risk", "SELECT from_json('1', 'int')", "SELECT spark_catalog.default.f(1)",
    "SELECT counterparty, IF(id > 1, (SELECT max(id) FROM secret_rows), 0) FROM counterparty_risk ORDER BY (SELECT max(id) FROM secret_rows)",
    "SELECT transform(a, v -> IDENTIFIER('abs')(v)) FROM counterparty_risk", "SELECT (", "FROM counterparty_risk SELECT id",
    "SELECT * FROM counterparty_risk a JOIN secret_rows b USING (id)", "SELECT * FROM parquet.`/tmp`", "WITH w AS (SHOW TABLES) SELECT * FROM w",
]
ALLOWED = [
    ("SELECT * FROM counterparty_risk WHERE counterparty = 'reflect' OR counterparty = 'java_method'", 0),
    ("SELECT 'IDENTIFIER(x)' AS s, 'range(5)' AS r", 1),
    ("WITH w AS (SELECT id, sum(x) OVER (PARTITION BY counterparty ORDER BY id ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS s FROM counterparty_risk), "
     "v AS (SELECT * FROM w WHERE s BETWEEN 0 AND 100) SELECT v.*, CASE WHEN v.s > 3 THEN 'a' ELSE 'b' END AS k FROM v JOIN w USING (id) ORDER BY v.s DESC LIMIT 4", 4),
    ("SELECT counterparty, count(DISTINCT id) AS n, round(avg(x), 2) AS m, max(id) FILTER (WHERE x > 1) AS t FROM counterparty_risk GROUP BY ROLLUP (counterparty)", 3),
    ("SELECT id FROM counterparty_risk p WHERE EXISTS (SELECT 1 FROM trades_pnl t WHERE t.id = p.id) AND x > (SELECT min(x) FROM trades_pnl)", 5),
    ("SELECT id, v FROM counterparty_risk LATERAL VIEW explode(a) t AS v", 12),
    ("SELECT id FROM counterparty_risk UNION SELECT id FROM trades_pnl EXCEPT SELECT 3", 5),
    ("SELECT transform(a, v -> v + 1) AS b, aggregate(a, 0, (s, v) -> s + v) AS c, element_at(a, 1) AS d FROM counterparty_risk", 6),
    ("SELECT date_trunc('month', ts) AS m, ts + INTERVAL 1 DAY AS n, year(ts) AS y, CAST(ts AS date) - DATE '2026-01-01' AS d FROM counterparty_risk", 6),
    ("SELECT * FROM (SELECT counterparty, x FROM counterparty_risk) PIVOT (sum(x) FOR counterparty IN ('p0', 'p1'))", 1),
    ("SELECT percentile_cont(0.5) WITHIN GROUP (ORDER BY x) AS p, median(x) AS m, mode(counterparty) AS o FROM counterparty_risk", 1),
    ("SELECT * FROM VALUES (1, 'a'), (2, 'b') t(n, s)", 2),
]


@pytest.mark.parametrize("sql", REFUSED)
def test_refused_before_anything_runs(spark, lake, sql):
    with pytest.raises(guard.StatementRefused):
        serving.query_data(spark, lake, sql)


@pytest.mark.parametrize("sql, n", ALLOWED)
def test_plain_questions_run(spark, lake, sql, n):
    rows, more = serving.query_data(spark, lake, sql)
    assert rows.count() == n and not more


def test_the_plan_decides_where_names_do_not(spark, lake):
    """A view of the right name over other files is refused by its leaf."""
    session = spark.newSession()
    other = session.read.parquet(f"{lake}/elsewhere")
    other.createOrReplaceTempView("counterparty_risk")
    guard.check_parsed(session, "SELECT * FROM counterparty_risk", {"counterparty_risk"})
    own = guard.locations(session.read.parquet(f"{lake}/3_gold/counterparty_risk"))
    for sql in ("SELECT * FROM counterparty_risk", "SELECT (SELECT max(id) FROM counterparty_risk)", "WITH w AS (SELECT * FROM counterparty_risk) SELECT 1 FROM w"):
        with pytest.raises(guard.StatementRefused, match="only files of the views"):
            guard.check_resolved(session, session.sql(sql), own)
        guard.check_resolved(session, session.sql(sql), guard.locations(other))
    with pytest.raises(guard.StatementRefused, match="Range"):
        guard.check_resolved(session, session.range(5), own)


def test_arguments_are_values_only(spark, lake):
    rows, _ = serving.query_data(spark, lake, "SELECT count(*) AS n FROM counterparty_risk WHERE counterparty = :who", {"who": "p1' OR '1' = '1"})
    assert rows.first().n == 0
    with pytest.raises(guard.StatementRefused):
        serving.query_data(spark, lake, "SELECT * FROM IDENTIFIER(:t)", {"t": "counterparty_risk"})
