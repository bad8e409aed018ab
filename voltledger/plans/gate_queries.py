"""Data-quality gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltledger.functions.contracts import MARKET_PRICES, STRICT_TRADES
from voltledger.operators import gates
from voltledger.plans import market_tables as M
from voltledger.plans import sql_parts as Q
from voltledger.plans.catalog import query
from voltledger.session import stage
from voltledger.sources import sinks

UNIT = """unit AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, epoch_us(l_shipdate) // 1000 AS timestamp_ms, l_extendedprice / l_quantity AS price_eur_mwh
  FROM lineitem),
routed AS (
  SELECT *, list_filter([
    CASE WHEN NOT timestamp_ms > 946684800000 THEN 'greater_than(946684800000)' END,
    CASE WHEN NOT timestamp_ms < 4102444800000 THEN 'less_than(4102444800000)' END,
    CASE WHEN NOT price_eur_mwh >= -500 THEN 'greater_than_or_equal_to(-500.0)' END,
    CASE WHEN NOT price_eur_mwh <= 4000 THEN 'less_than_or_equal_to(4000.0)' END], lambda x: x IS NOT NULL) AS failed
  FROM unit)"""

_VERDICT = """SELECT gate, rows_total, rows_total - rows_quarantined AS rows_clean, rows_quarantined,
  round(rows_quarantined / rows_total, 4) AS failure_ratio,
  rows_quarantined / rows_total <= 0.2 AND rows_total > rows_quarantined AS passed"""

_RAW_ROUTED = f"""{Q.RAW},
routed AS (
  SELECT *, list_filter([
    CASE WHEN NOT regexp_matches(trade_id, '^TRD-\\d{{8,}}\\z') THEN 'str_matches(''^TRD-\\d{{8,}}\\z'')' END,
    CASE WHEN count(*) OVER (PARTITION BY trade_id) > 1 THEN 'field_uniqueness' END,
    CASE WHEN NOT length(counterparty) BETWEEN 2 AND 50 THEN 'str_length(2, 50)' END,
    CASE WHEN commodity NOT IN ('POWER', 'NATURAL_GAS') THEN 'isin([''POWER'', ''NATURAL_GAS''])' END,
    CASE WHEN buy_sell NOT IN ('BUY', 'SELL') THEN 'isin([''BUY'', ''SELL''])' END,
    CASE WHEN NOT volume_mw > 0 THEN 'greater_than(0.0)' END,
    CASE WHEN NOT volume_mw <= 10000 THEN 'less_than_or_equal_to(10000.0)' END,
    CASE WHEN NOT price_eur_mwh >= -500 THEN 'greater_than_or_equal_to(-500.0)' END,
    CASE WHEN NOT price_eur_mwh <= 4000 THEN 'less_than_or_equal_to(4000.0)' END], lambda x: x IS NOT NULL) AS failed
  FROM raw)"""


def _routed_label(routed):
    return routed.withColumn("failed_checks", F.array_join(F.transform("failures", lambda f: f["check"]), "|"))


@query(Q.with_(UNIT, "SELECT l_orderkey, l_linenumber, timestamp_ms, price_eur_mwh, array_to_string(failed, '|') AS failed_checks, len(failed) = 0 AS clean FROM routed"))
def price_gate_rows(spark, sf_dir):
    routed = _routed_label(gates.route(M.unit_prices(spark, sf_dir), MARKET_PRICES))
    return routed.select("l_orderkey", "l_linenumber", "timestamp_ms", "price_eur_mwh", "failed_checks", (F.size("failures") == 0).alias("clean"))


@query(Q.with_(UNIT, f"""{_VERDICT} FROM (SELECT 'unit_prices' AS gate, count(*) AS rows_total, count(*) FILTER (len(failed) > 0) AS rows_quarantined FROM routed
UNION ALL SELECT 'event_prices', count(*), count(*) FILTER (NOT value BETWEEN -500 AND 4000) FROM events)"""))
def price_gate_verdict(spark, sf_dir):
    bad = gates.batch_verdict(gates.route(M.unit_prices(spark, sf_dir), MARKET_PRICES), "unit_prices")
    good = gates.batch_verdict(gates.route(M.price_series(spark, sf_dir), MARKET_PRICES), "event_prices")
    return bad.unionByName(good)


@query(Q.with_(_RAW_ROUTED, """SELECT trade_id, counterparty, CAST(price_eur_mwh AS DOUBLE) AS price_eur_mwh, array_to_string(failed, '|') AS failed_checks,
len(failed) = 0 AS clean FROM routed"""))
def trade_gate_rows(spark, sf_dir):
    routed = _routed_label(gates.route(M.raw_trades(spark, sf_dir), M.MAPPED_TRADES))
    return routed.select("trade_id", "counterparty", F.col("price_eur_mwh").cast("double").alias("price_eur_mwh"), "failed_checks", (F.size("failures") == 0).alias("clean"))


@query(Q.with_(_RAW_ROUTED, f"{_VERDICT} FROM (SELECT 'trades' AS gate, count(*) AS rows_total, count(*) FILTER (len(failed) > 0) AS rows_quarantined FROM routed)"))
def trade_gate_verdict(spark, sf_dir):
    return gates.batch_verdict(gates.route(M.raw_trades(spark, sf_dir), M.MAPPED_TRADES), "trades")


@query(Q.with_(_RAW_ROUTED, "SELECT trade_id, trader_id, CAST(CAST(volume_mw AS DOUBLE) AS VARCHAR) AS volume_mw, array_to_string(failed, '|') AS failed_checks FROM routed WHERE len(failed) > 0"))
def quarantined_trades(spark, sf_dir):
    """Rejected rows as the quarantine keeps them."""
    rejected = gates.quarantined_rows(gates.route(M.raw_trades(spark, sf_dir), M.MAPPED_TRADES))
    return rejected.select("trade_id", "trader_id", F.col("volume_mw").cast("string").alias("volume_mw"), F.array_join("failed_checks", "|").alias("failed_checks"))


@query(Q.with_(UNIT + """,
f AS (SELECT timestamp_ms, price_eur_mwh, unnest(failed) AS "check" FROM routed),
e AS (SELECT *, CASE WHEN "check" LIKE '%00000)' THEN CAST(timestamp_ms AS VARCHAR) ELSE CAST(price_eur_mwh AS VARCHAR) END AS value FROM f),
r AS (SELECT *, row_number() OVER (PARTITION BY "check" ORDER BY timestamp_ms, price_eur_mwh, value) AS rn FROM e)""",
'SELECT "check", count(*) AS failures, string_agg(value, \', \' ORDER BY rn) FILTER (rn <= 3) AS examples FROM r GROUP BY "check"'))
def gate_findings(spark, sf_dir):
    routed = gates.route(M.unit_prices(spark, sf_dir), MARKET_PRICES)
    return gates.check_findings(routed, ["timestamp_ms", "price_eur_mwh"]).select("check", "failures", F.array_join("examples", ", ").alias("examples"))


@query("""SELECT o_orderkey, array_to_string(list_filter([
  CASE WHEN o_orderstatus = 'P' THEN 'isin([''BUY'', ''SELL''])' END,
  CASE WHEN NOT o_totalprice / 1000 > 0 THEN 'greater_than(0)' END,
  CASE WHEN NOT c_acctbal > 0 THEN 'greater_than(0)' END], lambda x: x IS NOT NULL), '|') AS failed_checks
FROM orders JOIN customer ON o_custkey = c_custkey""")
def strict_profile(spark, sf_dir):
    """Orders read as trades under the strict profile; account balances stand in for prices."""
    orders, customers = M.table(spark, sf_dir, "orders"), M.table(spark, sf_dir, "customer")
    trades = orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        "o_orderkey", F.concat(F.lit("TRD-"), F.col("o_orderkey").cast("string")).alias("trade_id"),
        F.lit("TRADER-101").alias("trader_id"), F.col("c_name").alias("counterparty"), F.lit("POWER").alias("commodity"),
        F.when(F.col("o_orderstatus") == "O", "BUY").when(F.col("o_orderstatus") == "F", "SELL").otherwise("HOLD").alias("buy_sell"),
        (F.col("o_totalprice") / 1000).alias("volume_mw"), F.col("c_acctbal").alias("price_eur_mwh"),
        F.col("o_orderdate").alias("delivery_start"), F.col("o_orderdate").alias("delivery_end"),
    )
    return _routed_label(gates.route(trades, STRICT_TRADES)).select("o_orderkey", "failed_checks")


def _outlier_sql(group: str) -> str:
    g = "event_type" if group else "'all'"
    return f"""SELECT grp, count(*) AS n, max(med) AS median, round(max(scale), 4) AS mad_scale,
  count(*) FILTER (dev / scale > 5.0) AS outliers,
  CASE WHEN count(*) FILTER (dev / scale > 5.0) > 0 THEN CASE WHEN max(x) - max(med) >= max(med) - min(x) THEN max(x) ELSE min(x) END END AS worst
FROM (SELECT *, CASE WHEN median(dev) OVER (PARTITION BY grp) > 0 THEN median(dev) OVER (PARTITION BY grp) * 1.4826 ELSE stddev_samp(x) OVER (PARTITION BY grp) END AS scale
  FROM (SELECT *, abs(x - med) AS dev FROM (SELECT {g} AS grp, value AS x, median(value) OVER (PARTITION BY {g}) AS med FROM events))) GROUP BY grp"""


@query(f"{_outlier_sql('event_type')} UNION ALL {_outlier_sql('')}")
def robust_outliers(spark, sf_dir):
    """Per event type and over all events."""
    events = M.table(spark, sf_dir, "events").select("event_type", "value")
    per_type = gates.robust_outliers(events, "value", ["event_type"]).withColumnRenamed("event_type", "grp")
    overall = gates.robust_outliers(events, "value").select(F.lit("all").alias("grp"), "*")
    return per_type.unionByName(overall)


@query("SELECT count(*) AS rows_checked, count(*) FILTER (NOT l_extendedprice / l_quantity BETWEEN -50 AND 1000) AS implausible FROM lineitem")
def plausibility(spark, sf_dir):
    return gates.plausibility(M.unit_prices(spark, sf_dir))


@query(Q.with_(Q.RAW, "SELECT count(*) AS rows_checked, count(DISTINCT trade_id) AS distinct_ids, count(*) - count(DISTINCT trade_id) AS duplicates FROM raw"))
def replay_ids(spark, sf_dir):
    return gates.replayed_ids(M.raw_trades(spark, sf_dir))


_REPORT = f"""{Q.SILVER},
ev AS (SELECT value AS x, median(value) OVER () AS med FROM events),
ev2 AS (SELECT x, med, abs(x - med) AS dev FROM ev),
ev3 AS (SELECT *, median(dev) OVER () * 1.4826 AS scale FROM ev2),
out AS (SELECT count(*) FILTER (dev / scale > 5.0) AS n, max(x) AS hi, min(x) AS lo, max(med) AS med FROM ev3)"""


@query(Q.with_(_REPORT, """SELECT 'run' AS batch_source, true AS overall_passed, 'market_prices' AS gate, true AS passed,
  (SELECT count(*) FROM events) AS rows_clean, CAST(0 AS BIGINT) AS rows_quarantined,
  (SELECT printf('%d statistical outlier(s) in ''price_eur_mwh'' (robust z > 5.0; worst value %.2f, median %.2f) - possible data poisoning, review before trusting', n, round(CAST(hi AS DECIMAL(18,6)), 2), round(CAST(med AS DECIMAL(18,6)), 2)) FROM out) AS findings
UNION ALL SELECT 'run', true, 'trades', true, (SELECT count(*) FROM silver), 0, ''"""))
def quality_report(spark, sf_dir):
    """Both gates over whole tables, as the report sink would store them."""
    market = gates.validate_market_prices(M.price_series(spark, sf_dir))
    trades = gates.validate_trades(stage(M.silver_trades(spark, sf_dir), "silver"), M.MAPPED_TRADES)
    report = sinks.quality_report([market, trades], "run")
    return report.select("batch_source", "overall_passed", F.explode("gates").alias("g")).select(
        "batch_source", "overall_passed", F.col("g.name").alias("gate"), "g.passed", "g.rows_clean", "g.rows_quarantined",
        F.array_join("g.findings", "; ").alias("findings"))


@query(Q.with_(UNIT, "SELECT true AS conserved, count(*) AS rows_in, count(*) FILTER (len(failed) = 0) AS rows_clean, count(*) FILTER (len(failed) > 0) AS rows_quarantined FROM routed"))
def conservation(spark, sf_dir):
    """Clean and quarantined rows together are the input, as multisets."""
    source = M.unit_prices(spark, sf_dir)
    routed = stage(gates.route(source, MARKET_PRICES), "routed")
    clean, rejected = gates.clean_rows(routed, MARKET_PRICES), gates.quarantined_rows(routed).drop("failed_checks")
    # Signed counts per distinct row: all zero exactly when the multisets agree. Map-side combined.
    signed = source.withColumn("_n", F.lit(1)).unionByName(clean.unionByName(rejected).withColumn("_n", F.lit(-1)))
    differences = signed.groupBy(*source.columns).agg(F.sum("_n").alias("d")).agg(F.coalesce(F.sum(F.abs("d")), F.lit(0)) == 0)
    return routed.agg(
        F.count("*").alias("rows_in"), F.count_if(F.size("failures") == 0).alias("rows_clean"),
        F.count_if(F.size("failures") > 0).alias("rows_quarantined"),
    ).withColumn("conserved", differences.scalar())
