"""Silver, Gold, upsert, sources, sinks and serving."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

import books
from voltledger.operators import gold, serving, silver, upsert
from voltledger.session import release, scratch_path, scratch_root, stage
from voltledger.sources import bronze, files, sinks, tables


def test_silver_prices(spark):
    series = spark.createDataFrame(
        [(1723507200000, 85.4), (1723507200000, 80.0), (1723510800000, None)], "timestamp_ms long, price_eur_mwh double")
    (row,) = silver.to_silver_prices(series).collect()
    assert row.timestamp == dt.datetime(2024, 8, 13) and row.price_eur_mwh == 80.0 and row.commodity == "POWER"


def test_silver_trades_keep_one_row_per_id(spark):
    df = spark.createDataFrame(
        [("A", "7.5", "2026-01-02"), ("A", "7.5", "2026-01-01"), ("B", "bad", "bad")], "trade_id string, volume_mw string, created_at string"
    ).withColumn("price_eur_mwh", F.lit("1"))
    rows = {r.trade_id: r for r in silver.to_silver_trades(df, ["created_at"]).collect()}
    assert rows["A"].created_at == dt.datetime(2026, 1, 1) and rows["A"].volume_mw == 7.5
    assert rows["B"].volume_mw is None and rows["B"].created_at is None


def test_first_per_key_limits_rows_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 3)
    out = silver.first_per_key(df, "k", ["id"])
    assert out.count() == 3
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_insert_if_absent(spark):
    batch = spark.createDataFrame([(1, "b"), (1, "a"), (2, "x"), (3, "y")], "k int, v string")
    target = spark.createDataFrame([(2, "old")], "k int, v string")
    assert sorted(map(tuple, upsert.insert_if_absent(batch, target, "k", ["v"]).collect())) == [(1, "a"), (3, "y")]
    with pytest.raises(Exception, match="null k"):
        upsert.insert_if_absent(batch.unionByName(spark.createDataFrame([(None, "z")], "k int, v string")), target, "k", ["v"]).collect()


def trades(spark):
    rows = [
        ("T1", "POWER", "BUY", 10.0, 80.0), ("T2", "POWER", "SELL", 10.0, 80.0), ("T3", "NATURAL_GAS", "BUY", 3.0, 40.335),
        ("T4", None, "BUY", 1.0, 80.0), ("T5", "POWER", "HOLD", 1.0, 80.0), ("T6", "POWER", "BUY", 1.0, None), ("T7", "COAL", "SELL", 1.0, 80.0),
    ]
    return spark.createDataFrame(rows, "trade_id string, commodity string, buy_sell string, volume_mw double, price_eur_mwh double").withColumn("counterparty", F.lit("C"))


def test_valuation(spark):
    prices = spark.createDataFrame(
        [("POWER", dt.datetime(2026, 1, 1), 50.0), ("POWER", dt.datetime(2026, 1, 2), 91.5), ("POWER", dt.datetime(2026, 1, 2), 90.0)],
        "commodity string, timestamp timestamp, price_eur_mwh double")
    latest = gold.latest_price(prices)
    assert [tuple(r) for r in latest.collect()] == [("POWER", 90.0, dt.datetime(2026, 1, 2))]
    v = {r.trade_id: r for r in gold.value_trades(trades(spark), latest).collect()}
    assert (v["T1"].unrealized_pnl_eur, v["T2"].unrealized_pnl_eur) == (100.0, -100.0)
    assert v["T3"].effective_market_price == 42.5 and v["T3"].notional_value_eur == 121.01 and v["T3"].unrealized_pnl_eur == 6.5
    assert v["T4"].effective_market_price == v["T7"].effective_market_price == 85.0
    assert v["T5"].unrealized_pnl_eur == 0.0
    assert v["T6"].notional_value_eur is None and v["T6"].unrealized_pnl_eur is None and v["T6"].mtm_value_eur == 90.0


def test_gold_aggregates(spark):
    pnl = gold.value_trades(trades(spark), spark.createDataFrame([("POWER", 90.0)], "commodity string, latest_market_price double"))
    power = gold.portfolio_summary(pnl).where("commodity = 'POWER'").first()
    assert (power.total_trades, power.net_volume_mw, power.portfolio_notional_eur) == (4, 22.0, 1680.0)
    risk = gold.counterparty_risk(pnl)
    assert risk.count() == 4 and serving.exposure_by_counterparty(risk).first().exposure == 1961.01
    assert serving.top_counterparty_exposure(risk, 1).first().commodity == "POWER"
    with pytest.raises(ValueError):
        serving.top_counterparty_exposure(risk, -1)


def test_money_rounds_half_up_on_exact_decimals(spark):
    df = spark.createDataFrame([("T", "POWER", "BUY", 1.0, 1.005, "C")], "trade_id string, commodity string, buy_sell string, volume_mw double, price_eur_mwh double, counterparty string")
    latest = spark.createDataFrame([("POWER", 2.0)], "commodity string, latest_market_price double")
    assert gold.value_trades(df, latest).first().notional_value_eur == 1.01


def payload(prices, **more):
    return json.dumps({"market": "EPEX", "commodity": "POWER", "currency": "EUR", "unit": "MWh", "fetched_at": "now",
                       "series": [{"timestamp_ms": 1723507200000 + i * 3600000, "price_eur_mwh": p} for i, p in enumerate(prices)], **more}, indent=2)


def test_read_envelopes_and_latest_batch(spark, tmp_path):
    for stamp, prices in (("20260101_000000", [1.0]), ("20260102_000000", [2.0, None, 3.0])):
        (tmp_path / f"market_prices_{stamp}.json").write_text(payload(prices))
    newest = bronze.latest_batch(bronze.read_envelopes(spark, str(tmp_path)))
    assert [r.price_eur_mwh for r in bronze.series_rows(newest).collect()] == [2.0, 3.0]


def test_fingerprints_inline_and_streamed_agree(spark, tmp_path):
    import hashlib

    (tmp_path / "a b.bin").write_bytes(b"x" * 1000)
    want = hashlib.sha256(b"x" * 1000).hexdigest()
    for limit in (10_000, 10):
        (row,) = files.fingerprints(spark, str(tmp_path), inline_bytes=limit).collect()
        assert row.sha256 == want and row.bytes == 1000


def test_scan_json_files(spark, tmp_path):
    (tmp_path / "good.json").write_text(payload([1.0]))
    (tmp_path / "bad.json").write_text(payload([1.0], note="../../x"))
    (tmp_path / "broken.json").write_text("{")
    threats, report = files.scan_json_files(spark, str(tmp_path))
    verdicts = {r.file.rsplit("/", 1)[-1]: (r.clean, len(r.sha256)) for r in report.collect()}
    assert verdicts == {"good.json": (True, 64), "bad.json": (False, 64), "broken.json": (False, 64)}
    assert {r.label for r in threats.collect()} == {"path traversal sequence", "malformed JSON"}
    assert not report.first().malware_scanner_available


def test_inventory(spark, tmp_path):
    for layer, n in (("1_bronze", 2), ("2_silver", 3)):
        (tmp_path / layer).mkdir()
        for i in range(n):
            (tmp_path / layer / f"{i}.json").write_text("{}")
    rows = {r.layer: (r.files, r.bytes, r.fresh_files) for r in files.inventory(spark, {k: str(tmp_path / k) for k in ("1_bronze", "2_silver")}).collect()}
    assert rows == {"1_bronze": (2, 4, 2), "2_silver": (3, 6, 3)}


def test_absent_dataset_is_empty_and_unknown_is_refused(spark, tmp_path):
    assert tables.read_dataset(spark, str(tmp_path), "trades_pnl").count() == 0
    with pytest.raises(ValueError, match="unknown dataset"):
        tables.read_dataset(spark, str(tmp_path), "passwords")
    with pytest.raises(tables.MissingData):
        tables.scoring_source(spark, str(tmp_path))


def test_jdbc_scan_is_split_by_key_ranges():
    options = tables.jdbc_options("jdbc:postgresql://h/db", "raw_trades", "id", (0, 1000), 16)
    assert options["numPartitions"] == "16" and options["partitionColumn"] == "id" and options["upperBound"] == "1000"
    assert "partitionColumn" not in tables.jdbc_options("jdbc:postgresql://h/db", "raw_trades")


def test_reports_and_quarantine(spark, tmp_path):
    out = str(tmp_path)
    one = spark.range(1).select(F.lit(5).alias("n_scored"))
    for kind, stamp in (("quality", "20260101"), ("quality", "20260102"), ("drift", "20260101")):
        sinks.write_report(one, f"{out}/reports", kind, stamp)
    newest = {r.kind: r.stamp for r in serving.latest_reports(sinks.read_reports(spark, f"{out}/reports")).collect()}
    assert newest == {"quality": "20260102", "drift": "20260101"}
    assert serving.report_names(sinks.read_reports(spark, f"{out}/reports")).first().name == "quality_report_20260102"
    assert sinks.write_quarantine(one.limit(0), f"{out}/q", "g", "s") is None
    assert spark.read.parquet(sinks.write_quarantine(one, f"{out}/q", "g", "s")).count() == 1
    assert sinks.read_reports(spark, f"{out}/none").isEmpty()


def test_query_data_is_read_only_and_knows_four_views(spark, tmp_path):
    root = str(tmp_path)
    spark.range(700).select(F.lit("C").alias("counterparty"), F.col("id").cast("double").alias("total_notional_eur")).write.parquet(f"{root}/3_gold/counterparty_risk")
    rows, more = serving.query_data(spark, root, "SELECT * FROM counterparty_risk")
    assert rows.count() == 500 and more
    rows, more = serving.query_data(spark, root, "SELECT count(*) AS n FROM counterparty_risk WHERE total_notional_eur >= :x", {"x": 690})
    assert rows.first().n == 10 and not more
    with pytest.raises(serving.StatementRefused):
        serving.query_data(spark, root, "DROP VIEW counterparty_risk")
    with pytest.raises(serving.StatementRefused):
        serving.query_data(spark, root, f"SELECT * FROM parquet.`{root}/3_gold/counterparty_risk`")
    assert spark.conf.get("spark.sql.runSQLOnFiles") == "true"


@pytest.mark.parametrize("sql", [
    "SELECT * FROM default.hidden_rows", "SELECT * FROM hidden_rows", "SELECT * FROM spark_catalog.default.hidden_rows",
    "SELECT * FROM global_temp.shared_rows", "WITH hidden_rows AS (SELECT * FROM hidden_rows) SELECT * FROM hidden_rows",
    "SELECT (SELECT max(id) FROM default.hidden_rows) FROM counterparty_risk",
    "SELECT reflect('java.lang.System', 'getProperty', 'user.dir')", "SELECT java_method('java.util.UUID', 'randomUUID')",
    "SELECT `Try_Reflect`('java.lang.Math', 'abs', 1)", "SELECT * FROM counterparty_risk WHERE EXISTS (SELECT 1 FROM global_temp.shared_rows)",
    "SELECT * FROM text.`/etc/hostname`",
])
def test_statements_cannot_leave_the_views(spark, tmp_path, sql):
    root = str(tmp_path)
    spark.range(3).withColumn("counterparty", F.lit("C")).write.parquet(f"{root}/3_gold/counterparty_risk")
    spark.range(2).createOrReplaceGlobalTempView("shared_rows")
    spark.range(2).write.mode("overwrite").saveAsTable("hidden_rows", path=f"{root}/elsewhere")
    try:
        with pytest.raises(serving.StatementRefused):
            serving.query_data(spark, root, sql)
        rows, more = serving.query_data(spark, root, "WITH a AS (SELECT id FROM counterparty_risk) SELECT a.id, x FROM a LATERAL VIEW explode(array(1, 2)) t AS x")
        assert rows.count() == 6 and not more
    finally:
        spark.sql("DROP TABLE hidden_rows")


def test_long_order_keys_keep_their_trades(spark, tmp_path):
    from voltledger.plans import market_tables as M

    keys = [12345678, 123456781, 1234567812, 1234567813]
    for name, row, schema in (
        ("lineitem", lambda k: (k, 1, 1, 1, 5.0, 10.0, 0.0, 0.0, "O", "N", dt.datetime(2024, 1, 1)), "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_linestatus string, l_returnflag string, l_shipdate timestamp_ntz"),
        ("orders", lambda k: (k, 1, dt.datetime(2024, 1, 1)), "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
    ):
        spark.createDataFrame([row(k) for k in keys], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    spark.createDataFrame([(1, "C#1")], "c_custkey long, c_name string").write.parquet(f"{tmp_path}/customer.parquet")
    ids = {r.trade_id for r in M.raw_trades(spark, str(tmp_path)).collect()}
    assert ids == {f"TRD-{10 * k + 1}" for k in keys}
    assert M.MAPPED_TRADES.columns


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    from unittest.mock import MagicMock

    from voltledger import session

    remote = MagicMock()
    remote.sparkContext.master = "spark://host:7077"
    remote._jsc.hadoopConfiguration().get.return_value = "hdfs://nn"
    remote.conf.get.return_value = "/user/warehouse"
    assert session._own_folder(remote) == "/user/warehouse/_scratch"
    remote.conf.get.return_value = "file:/tmp/warehouse"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session._own_folder(remote)


def test_lake_listing_names_what_exists(spark, tmp_path):
    assert serving.list_lake(spark, str(tmp_path)).isEmpty()
    spark.range(3).write.parquet(f"{tmp_path}/3_gold/trades_pnl")
    spark.range(2).selectExpr("id AS n", "'x' AS risk_band").write.parquet(f"{tmp_path}/3_gold/trade_surveillance/run=1")
    assert {tuple(r) for r in serving.list_lake(spark, str(tmp_path)).collect()} == {
        ("trades_pnl", "id (bigint)", 3), ("trade_surveillance", "n (bigint), risk_band (string)", 2)}


def test_serving_lists(spark):
    scored = spark.createDataFrame(
        [("A", 0.9, True, "CRITICAL"), ("B", 0.9, False, "CRITICAL"), ("C", 0.4, True, "MEDIUM"), ("D", 0.1, False, "LOW")],
        "trade_id string, anomaly_score double, is_anomaly boolean, risk_band string")
    assert [r.trade_id for r in serving.suspicious_trades(scored).collect()] == ["A", "B"]
    assert serving.worst_trade(scored).first().trade_id == "A"
    assert [tuple(r)[1:] for r in serving.band_counts(scored).collect()] == [("CRITICAL", 2), ("HIGH", 0), ("MEDIUM", 1), ("LOW", 1)]
    portfolio = spark.createDataFrame([("POWER", 3, 10.1, 0.2), ("GAS", 1, 0.2, 0.1)], "commodity string, total_trades long, portfolio_notional_eur double, total_portfolio_pnl_eur double")
    assert tuple(serving.kpi_row(portfolio, scored).first()) == (4, 10.3, 0.3, 2)
    assert serving.capped(spark.range(5), ["id"], 3).first().truncated and not serving.capped(spark.range(3), ["id"], 3).first().truncated
    with pytest.raises(ValueError):
        serving.suspicious_trades(scored, limit=-1)


def test_staged_tables_live_below_the_checkpoint_folder(spark):
    staged = stage(spark.range(3))
    assert staged.count() == 3 and staged.inputFiles()[0].removeprefix("file://").startswith(scratch_root(spark).removeprefix("file:"))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert callable(release)


def test_books_fixture_passes_its_own_contract(spark):
    from voltledger.functions.contracts import STRICT_TRADES
    from voltledger.operators.gates import batch_verdict, route

    assert batch_verdict(route(books.frame(spark, books.rows(30, 1)), STRICT_TRADES), "strict").first().rows_quarantined == 0
