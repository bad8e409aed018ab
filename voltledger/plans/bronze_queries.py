"""Sources, Bronze and Silver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltledger.operators import silver, upsert
from voltledger.plans import market_tables as M
from voltledger.plans import sql_parts as Q
from voltledger.plans.catalog import query
from voltledger.session import scratch_path
from voltledger.sources import bronze, files, sinks, tables


def _text(timestamp: Column) -> Column:
    """Timestamps are compared as text, the same in any session time zone."""
    return F.date_format(timestamp, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def _envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a payload text whose series also holds items without a price."""
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    item = "struct<timestamp_ms: bigint, price_eur_mwh: double>"
    series = F.array(
        F.struct(ms.alias("timestamp_ms"), F.col("value").alias("price_eur_mwh")).cast(item),
        F.struct((ms + 3_600_000).alias("timestamp_ms"), F.lit(None).cast("double").alias("price_eur_mwh")).cast(item),
    )
    return M.table(spark, sf_dir, "events").select(
        "event_id", "event_type",
        F.to_json(F.struct(
            F.lit("EPEX_SPOT_GERMANY").alias("market"), F.lit("POWER").alias("commodity"), F.lit("EUR").alias("currency"),
            F.lit("MWh").alias("unit"), series.alias("series"),
        )).alias("json"),
    )


@query("SELECT event_id, epoch_us(ts) // 1000 AS timestamp_ms, value AS price_eur_mwh FROM events")
def bronze_series_rows(spark, sf_dir):
    parsed = bronze.parse_envelopes(_envelopes(spark, sf_dir), "json")
    return bronze.series_rows(parsed, "envelope.series", keep=("event_id",))


@query("SELECT event_id, epoch_us(ts) // 1000 AS timestamp_ms, value AS price_eur_mwh FROM events")
def pair_series_rows(spark, sf_dir):
    ms = F.unix_millis(F.col("ts").cast("timestamp")).cast("double")
    none = F.lit(None).cast("double")
    pairs = M.table(spark, sf_dir, "events").select(
        "event_id", F.array(F.array(ms, F.col("value")), F.array(ms + 1), F.array(ms + 2, none)).alias("pairs"))
    return bronze.pair_rows(pairs, "pairs", keep=("event_id",))


@query("""SELECT event_id, strftime(ts, '%Y%m%d') AS ingest_stamp, value FROM events
WHERE strftime(ts, '%Y%m%d') = (SELECT max(strftime(ts, '%Y%m%d')) FROM events)""")
def latest_batch(spark, sf_dir):
    stamped = M.table(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", "yyyyMMdd").alias("ingest_stamp"), "value")
    return bronze.latest_batch(stamped)


@query("SELECT epoch_us(ts) // 1000 AS timestamp_ms, value AS price_eur_mwh, 'POWER' AS commodity, 'clean' AS injection_scan, (SELECT count(*) FROM events) AS rows_accepted FROM events")
def verified_landing(spark, sf_dir):
    """Clean rows plus audit record, landed as JSON and read back."""
    rows = M.table(spark, sf_dir, "events").select(
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp_ms"), F.col("value").alias("price_eur_mwh"))
    audit = {"injection_scan": F.lit("clean"), "rows_accepted": F.lit(rows.count()), "rows_quarantined": F.lit(0),
             "quality_report": F.lit("quality_report")}
    out = scratch_path(spark, "bronze")
    bronze.land_bronze(bronze.verified_rows(rows, audit, {"commodity": F.lit("POWER")}), out, "20240101_000000")
    return bronze.latest_batch(bronze.read_verified(spark, out)).select(
        "timestamp_ms", "price_eur_mwh", "commodity", "security.injection_scan", "security.rows_accepted")


@query(Q.with_(Q.RAW, f"""SELECT trade_id, counterparty, commodity, CAST(volume_mw AS DOUBLE) AS volume_mw, CAST(price_eur_mwh AS DOUBLE) AS price_eur_mwh
FROM raw WHERE trade_id NOT IN (SELECT trade_id FROM raw WHERE o_orderstatus = 'F')
QUALIFY row_number() OVER (PARTITION BY trade_id ORDER BY {Q.SURVIVOR}) = 1"""))
def insert_if_absent(spark, sf_dir):
    """Trades of all orders against a ledger that already holds those of filled orders."""
    extra = [c for c in M.SURVIVOR_ORDER if c.startswith("l_")] + ["o_orderstatus"]
    batch = M.raw_trades(spark, sf_dir, extra)
    ledger = batch.where("o_orderstatus = 'F'").select("trade_id").distinct()
    return upsert.insert_if_absent(batch, ledger, "trade_id", M.SURVIVOR_ORDER).select(
        "trade_id", "counterparty", "commodity",
        F.col("volume_mw").cast("double").alias("volume_mw"), F.col("price_eur_mwh").cast("double").alias("price_eur_mwh"))


@query("SELECT event_id, NOT json_valid(CASE WHEN event_type = 'error' THEN left(props, length(props) - 1) ELSE props END) AS malformed FROM events")
def malformed_json(spark, sf_dir):
    """Event properties, cut off mid-document for error events."""
    cut = F.when(F.col("event_type") == "error", F.left("props", F.length("props") - 1)).otherwise(F.col("props"))
    texts = M.table(spark, sf_dir, "events").select("event_id", cut.alias("json"))
    return bronze.parse_envelopes(texts, "json", "k bigint").select("event_id", "malformed")


@query("SELECT event_id, strftime(date_trunc('milliseconds', ts), '%Y-%m-%d %H:%M:%S.%f') AS timestamp FROM events")
def epoch_ms(spark, sf_dir):
    return M.table(spark, sf_dir, "events").select(
        "event_id", _text(F.timestamp_millis(F.unix_millis(F.col("ts").cast("timestamp")))).alias("timestamp"))


@query("""SELECT strftime(date_trunc('milliseconds', ts), '%Y-%m-%d %H:%M:%S.%f') AS timestamp, 'POWER' AS commodity, min(CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE)) AS price_eur_mwh
FROM events GROUP BY 1""")
def silver_prices(spark, sf_dir):
    return silver.to_silver_prices(M.price_series(spark, sf_dir)).withColumn("timestamp", _text(F.col("timestamp")))


_TRADE = """trade_id, trader_id, counterparty, commodity, buy_sell, CAST(volume_mw AS DOUBLE) AS volume_mw,
CAST(price_eur_mwh AS DOUBLE) AS price_eur_mwh, """ + ", ".join(f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f') AS {c}" for c in silver.TIMESTAMP_COLUMNS)


@query(Q.with_(Q.SILVER, f"SELECT {_TRADE} FROM silver"))
def silver_trades(spark, sf_dir):
    trades = M.silver_trades(spark, sf_dir)
    return trades.withColumns({c: _text(F.col(c)) for c in silver.TIMESTAMP_COLUMNS})


@query("SELECT event_type, count(*) AS n, sum(CAST(value AS DECIMAL(18,2)))::DOUBLE AS total FROM events GROUP BY event_type")
def recursive_scan(spark, sf_dir):
    """Events written as a nested folder tree and read back as one dataset."""
    out = scratch_path(spark, "tree")
    M.table(spark, sf_dir, "events").withColumn("kind", F.col("event_type")).write.partitionBy("kind").parquet(out)
    return tables.read_parquet_tree(spark, out).groupBy("event_type").agg(
        F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"))


@query("""SELECT 'lineitem' AS batch, CAST(l_orderkey AS BIGINT) AS k, l_returnflag AS flag, NULL AS priority FROM lineitem
UNION ALL SELECT 'orders', o_orderkey, NULL, o_orderpriority FROM orders""")
def concat_batches(spark, sf_dir):
    lines = M.table(spark, sf_dir, "lineitem").select(F.lit("lineitem").alias("batch"), F.col("l_orderkey").alias("k"), F.col("l_returnflag").alias("flag"))
    orders = M.table(spark, sf_dir, "orders").select(F.lit("orders").alias("batch"), F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("priority"))
    return tables.concat_batches(lines, orders)


@query()
def file_fingerprint(spark, sf_dir):
    return files.fingerprints(spark, sf_dir).select(F.element_at(F.split("file", "/"), -1).alias("file"), "bytes", "sha256")


@query()
def layer_inventory(spark, sf_dir):
    """Files and bytes of the given tables and of the Silver prices written from them."""
    out = scratch_path(spark, "silver")
    sinks.overwrite(silver.to_silver_prices(M.price_series(spark, sf_dir)), out)
    return files.inventory(spark, {"1_bronze": sf_dir, "2_silver": out}).select("layer", "files", "bytes", "fresh_files")


@query("""SELECT event_type, CAST(sum(CASE WHEN value IS NULL THEN 11 ELSE 12 END) AS BIGINT) AS strings_checked, count(*) FILTER (event_type = 'error') AS threats,
count(*) FILTER (event_type = 'error') AS reported, event_type <> 'error' AS clean, true AS hashed FROM events GROUP BY event_type""")
def json_file_scan(spark, sf_dir):
    """Payload texts written as JSON line files, a folder per event type; errors carry a hostile market name."""
    out = scratch_path(spark, "payload-files")
    hostile = F.replace("json", F.lit("EPEX_SPOT_GERMANY"), F.lit("../../etc"))
    texts = _envelopes(spark, sf_dir).withColumn("json", F.when(F.col("event_type") == "error", hostile).otherwise(F.col("json")))
    texts.select("event_type", "json").write.partitionBy("event_type").text(out)
    threats, report = files.scan_json_files(spark, out, lines=True)
    kind = F.regexp_extract("file", "event_type=([^/]+)/", 1).alias("event_type")
    reported = threats.groupBy(kind).agg(F.count("*").alias("reported"))
    # Spark's own marker files of the write lie above the folders.
    return report.where(F.contains("file", F.lit("event_type="))).groupBy(kind).agg(
        F.sum("strings_checked").alias("strings_checked"), F.sum("threats").alias("threats"), F.every("clean").alias("clean"),
        F.every(F.length("sha256") == 64).alias("hashed"),
    ).join(reported, "event_type", "left").withColumn("reported", F.coalesce("reported", F.lit(0)))


@query("SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice, (SELECT count(*) FROM orders) AS rows_before FROM orders WHERE o_orderstatus = 'F'")
def replaced_table(spark, sf_dir):
    """All orders, then the filled ones of the table's own rows in their place; the first reader still has its version."""
    out = scratch_path(spark, "orders")
    first = sinks.overwrite(M.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("double")), out)
    sinks.overwrite(tables.read_parquet_tree(spark, out).where("o_orderstatus = 'F'"), out)
    before = first.agg(F.count("*")).scalar()
    return tables.read_parquet_tree(spark, out).select("o_orderkey", "o_totalprice", before.alias("rows_before"))


