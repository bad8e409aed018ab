"""Valuation and Gold aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltledger.functions.texts import compact_eur
from voltledger.operators import gold, serving
from voltledger.plans import market_tables as M
from voltledger.plans import sql_parts as Q
from voltledger.plans.catalog import query

_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


@query("""SELECT event_type AS commodity, arg_max(CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE), ts) AS latest_market_price, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS market_price_as_of
FROM events GROUP BY event_type""")
def latest_market_price(spark, sf_dir):
    """Event types as commodities."""
    prices = M.table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("timestamp"), F.col("event_type").alias("commodity"),
        F.col("value").cast("decimal(18,2)").cast("double").alias("price_eur_mwh"))
    return gold.latest_price(prices).withColumn("market_price_as_of", F.date_format("market_price_as_of", _FORMAT))


@query(Q.with_(Q.PNL, """SELECT trade_id, counterparty, commodity, buy_sell, CAST(volume_mw AS DOUBLE) AS volume_mw, CAST(price_eur_mwh AS DOUBLE) AS price_eur_mwh,
CAST(market AS DOUBLE) AS effective_market_price, CAST(notional AS DOUBLE) AS notional_value_eur, CAST(mtm AS DOUBLE) AS mtm_value_eur, CAST(pnl AS DOUBLE) AS unrealized_pnl_eur FROM pnl"""))
def trades_pnl(spark, sf_dir):
    return M.valued_trades(spark, sf_dir).select(
        "trade_id", "counterparty", "commodity", "buy_sell", "volume_mw", "price_eur_mwh", "effective_market_price",
        "notional_value_eur", "mtm_value_eur", "unrealized_pnl_eur")


@query(Q.with_(Q.RISK, "SELECT * FROM risk"))
def counterparty_risk(spark, sf_dir):
    return gold.counterparty_risk(M.valued_trades(spark, sf_dir))


@query(Q.with_(Q.PORTFOLIO, "SELECT * FROM portfolio"))
def portfolio_summary(spark, sf_dir):
    return gold.portfolio_summary(M.valued_trades(spark, sf_dir))


@query("""SELECT event_id, CAST(coalesce(CASE WHEN event_type = 'click' THEN value END, CASE WHEN event_type = 'view' THEN 42.5 ELSE 85.0 END) AS DOUBLE) AS price FROM events""")
def fallback_price(spark, sf_dir):
    """Only clicks have a market price; views count as gas."""
    kind = F.col("event_type")
    commodity = F.when(kind == "view", "NATURAL_GAS").when(kind == "error", F.lit(None)).otherwise("POWER")
    return M.table(spark, sf_dir, "events").select(
        "event_id", gold.fallback_price(F.when(kind == "click", F.col("value")), commodity).alias("price"))


@query(Q.with_(Q.PNL, """SELECT trade_id, buy_sell, commodity, CAST(volume_mw AS DOUBLE) AS volume_mw, CAST(price_eur_mwh AS DOUBLE) AS price_eur_mwh,
CAST(market AS DOUBLE) AS effective_market_price, CAST(notional AS DOUBLE) AS notional_value_eur, CAST(mtm AS DOUBLE) AS mtm_value_eur,
CASE WHEN buy_sell = 'BUY' THEN 'volume x (market - agreed)' ELSE 'volume x (agreed - market)' END AS pnl_formula, CAST(pnl AS DOUBLE) AS unrealized_pnl_eur FROM pnl"""))
def valuation_terms(spark, sf_dir):
    return gold.valuation_terms(M.valued_trades(spark, sf_dir))


@query(Q.with_(Q.RISK, """SELECT counterparty, commodity, trade_count, total_notional_eur, total_mtm_eur, net_unrealized_pnl_eur FROM risk
ORDER BY total_notional_eur DESC, counterparty, commodity LIMIT 10"""))
def top_exposure(spark, sf_dir):
    return serving.top_counterparty_exposure(gold.counterparty_risk(M.valued_trades(spark, sf_dir)))


@query(Q.with_(Q.RISK, "SELECT counterparty, CAST(sum(CAST(total_notional_eur AS DECIMAL(28,2))) AS DOUBLE) AS exposure FROM risk GROUP BY counterparty"))
def exposure_by_counterparty(spark, sf_dir):
    return serving.exposure_by_counterparty(gold.counterparty_risk(M.valued_trades(spark, sf_dir)))


@query(Q.with_(Q.SILVER, """SELECT trade_id, counterparty, commodity, buy_sell, CAST(volume_mw AS DOUBLE) AS volume_mw, CAST(price_eur_mwh AS DOUBLE) AS price_eur_mwh, strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS created_at
FROM silver ORDER BY silver.created_at DESC, trade_id LIMIT 5"""))
def recent_trades(spark, sf_dir):
    return serving.recent_trades(M.silver_trades(spark, sf_dir)).withColumn("created_at", F.date_format("created_at", _FORMAT))


@query("SELECT min(value) AS min_price, max(value) AS max_price FROM events")
def price_range(spark, sf_dir):
    return M.market_prices(spark, sf_dir).agg(F.min("price_eur_mwh").alias("min_price"), F.max("price_eur_mwh").alias("max_price"))


ALL_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
              "benchmark", "labels", "conversations")


@query(" UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS rows FROM {t}" for t in ALL_TABLES))
def row_counts(spark, sf_dir):
    return serving.list_tables({t: M.table(spark, sf_dir, t) for t in ALL_TABLES}).drop("columns")


@query(Q.with_(Q.RISK, """SELECT counterparty, commodity, CASE WHEN abs(total_notional_eur) >= 1e9 THEN printf('€%.2fB', total_notional_eur / 1e9)
WHEN abs(total_notional_eur) >= 1e6 THEN printf('€%.2fM', total_notional_eur / 1e6)
WHEN abs(total_notional_eur) >= 1e3 THEN printf('€%.2fk', total_notional_eur / 1e3) ELSE printf('€%.0f', total_notional_eur) END AS shown FROM risk"""))
def compact_amounts(spark, sf_dir):
    risk = gold.counterparty_risk(M.valued_trades(spark, sf_dir))
    return risk.select("counterparty", "commodity", compact_eur(F.col("total_notional_eur")).alias("shown"))
