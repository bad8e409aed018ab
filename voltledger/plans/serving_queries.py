"""Serving: ranked lists, bands, key figures, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltledger.operators import features, gates, gold, serving, surveillance
from voltledger.operators.quantiles import exact_quantiles
from voltledger.plans import market_tables as M
from voltledger.plans import sql_parts as Q
from voltledger.plans.catalog import query
from voltledger.plans.feature_queries import DRIFT, DRIFT_ROWS, LIVE_PRICES
from voltledger.plans.gate_queries import UNIT
from voltledger.plans.surrogate import surrogate_scored
from voltledger.session import scratch_path, stage
from voltledger.sources import sinks
from voltledger.sources.tables import dataset_path


def _scored(spark, sf_dir):
    return stage(surrogate_scored(spark, sf_dir), "surrogate")


@query(Q.with_(Q.SCORED, """SELECT b.band_order, b.risk_band, count(s.trade_id) AS trades
FROM (VALUES (0, 'CRITICAL'), (1, 'HIGH'), (2, 'MEDIUM'), (3, 'LOW')) b(band_order, risk_band) LEFT JOIN scored s ON s.risk_band = b.risk_band GROUP BY ALL"""))
def band_counts(spark, sf_dir):
    return serving.band_counts(surrogate_scored(spark, sf_dir))


@query(Q.with_(Q.SCORED, "SELECT risk_band, count(*) AS trades, round(avg(anomaly_score), 3) AS avg_score FROM scored GROUP BY risk_band"))
def band_avg(spark, sf_dir):
    return serving.band_averages(surrogate_scored(spark, sf_dir))


@query(Q.with_(Q.SCORED, """SELECT is_anomaly, median(volume_mw) AS volume_mw, median(price_eur_mwh) AS price_eur_mwh, median(anomaly_score) AS anomaly_score
FROM scored GROUP BY is_anomaly"""))
def flag_medians(spark, sf_dir):
    """Normal against flagged trades."""
    scored = _scored(spark, sf_dir)
    out = None
    for c in ("volume_mw", "price_eur_mwh", "anomaly_score"):
        m = exact_quantiles(scored, c, ["is_anomaly"], alias=c)
        out = m if out is None else out.join(m, "is_anomaly")
    return out


_SUSPICIOUS = "trade_id, counterparty, commodity, buy_sell, volume_mw, price_eur_mwh, anomaly_score, risk_band, top_reason"


@query(Q.with_(Q.SCORED, f"SELECT {_SUSPICIOUS} FROM scored WHERE anomaly_score >= 0.5 ORDER BY anomaly_score DESC, trade_id LIMIT 20"))
def suspicious_trades(spark, sf_dir):
    return serving.suspicious_trades(surrogate_scored(spark, sf_dir))


@query(Q.with_(Q.SCORED, f"SELECT {_SUSPICIOUS} FROM scored ORDER BY anomaly_score DESC, trade_id LIMIT 1"))
def worst_trade(spark, sf_dir):
    return serving.worst_trade(surrogate_scored(spark, sf_dir))


@query(Q.with_(Q.SCORED, "SELECT trade_id, risk_band, anomaly_score FROM scored WHERE is_anomaly"))
def flagged_trades(spark, sf_dir):
    return serving.flagged_trades(surrogate_scored(spark, sf_dir)).select("trade_id", "risk_band", "anomaly_score")


@query(Q.with_(Q.SCORED, "SELECT count(*) AS scored, count(*) FILTER (is_anomaly) AS flagged, round(count(*) FILTER (is_anomaly) / count(*), 4) AS alert_rate FROM scored"))
def alert_rate(spark, sf_dir):
    return surveillance.alert_rate(surrogate_scored(spark, sf_dir))


@query(Q.with_(f"{Q.SCORED},\n{Q.PORTFOLIO.removeprefix(Q.SILVER + ',')}", """SELECT CAST(sum(total_trades) AS BIGINT) AS total_trades,
CAST(sum(CAST(portfolio_notional_eur AS DECIMAL(28,2))) AS DOUBLE) AS portfolio_notional_eur,
CAST(sum(CAST(total_portfolio_pnl_eur AS DECIMAL(28,2))) AS DOUBLE) AS total_portfolio_pnl_eur,
(SELECT count(*) FROM scored WHERE is_anomaly) AS alerts FROM portfolio"""))
def kpi_row(spark, sf_dir):
    trades = stage(M.silver_trades(spark, sf_dir), "silver")
    portfolio = gold.portfolio_summary(M.valued_trades(spark, sf_dir, trades))
    return serving.kpi_row(portfolio, surrogate_scored(spark, sf_dir, trades))


@query(Q.with_(Q.SILVER, "SELECT counterparty, count(*) AS n, (SELECT count(DISTINCT counterparty) FROM silver) AS entities FROM silver GROUP BY counterparty"))
def value_counts(spark, sf_dir):
    counts = serving.value_counts(M.silver_trades(spark, sf_dir), "counterparty")
    return counts.withColumn("entities", counts.agg(F.count("*")).scalar())


@query("""SELECT event_type AS kind, max(strftime(ts, '%Y%m%d')) AS stamp, arg_max(props, ts) AS report FROM events GROUP BY event_type""")
def latest_reports(spark, sf_dir):
    """Event types as report kinds, every event a report."""
    reports = M.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("kind"), F.date_format("ts", "yyyyMMdd_HHmmss.SSSSSS").alias("stamp"), F.col("props").alias("report"))
    return serving.latest_reports(reports).withColumn("stamp", F.substring("stamp", 1, 8))


@query("SELECT event_type || '_report_' || strftime(ts, '%Y%m%d_%H%M%S') || '_' || event_id AS name FROM events ORDER BY name DESC LIMIT 10")
def report_names(spark, sf_dir):
    reports = M.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("kind"),
        F.concat(F.date_format("ts", "yyyyMMdd_HHmmss"), F.lit("_"), F.col("event_id").cast("string")).alias("stamp"))
    return serving.report_names(reports)


_STATUS = f"""{DRIFT},
{UNIT},
drifted AS ({DRIFT_ROWS}),
judged AS (SELECT count(*) AS n, count(*) FILTER (len(failed) > 0) AS bad FROM routed)"""


@query(Q.with_(_STATUS, """SELECT 'quality' AS kind, '20240102_000000' AS stamp, bad / n <= 0.2 AND bad < n AS passed, n - bad AS rows, bad AS findings, '' AS features FROM judged
UNION ALL SELECT 'drift', '20240102_000000', count(*) = 0, (SELECT count(*) FROM silver), count(*), coalesce(string_agg(feature, ',' ORDER BY feature), '') FROM drifted"""))
def data_quality_status(spark, sf_dir):
    """Two runs of gate and drift report; the second batch breaks the price limits and its market prices have moved."""
    out = scratch_path(spark, "reports")
    trades = stage(M.silver_trades(spark, sf_dir), "silver")
    counts = features.feature_counts(trades)
    trained = stage(features.build_features(trades, counts=counts), "features")
    baseline = stage(features.feature_baseline(trained), "baseline")
    scored = trades.select(F.lit(False).alias("is_anomaly"))
    runs = {"20240101_000000": (M.price_series(spark, sf_dir), trained),
            "20240102_000000": (M.unit_prices(spark, sf_dir), features.build_features(trades, LIVE_PRICES, counts=counts))}
    for stamp, (batch, book) in runs.items():
        gate = gates.validate_market_prices(batch)
        sinks.write_report(sinks.quality_report([gate], "prices"), out, "quality", stamp)
        drift = surveillance.drift_report(book, baseline)
        sinks.write_report(sinks.drift_summary(drift, scored), out, "drift", stamp)
    return serving.data_quality_status(sinks.read_reports(spark, out)).withColumn("features", F.array_join("features", ","))


@query(Q.with_(Q.RISK, """SELECT * FROM (SELECT counterparty, commodity, total_notional_eur, (SELECT count(*) > 500 FROM risk) AS truncated FROM risk
ORDER BY total_notional_eur DESC, counterparty, commodity LIMIT 500)"""))
def row_cap(spark, sf_dir):
    risk = gold.counterparty_risk(M.valued_trades(spark, sf_dir)).select("counterparty", "commodity", "total_notional_eur")
    return serving.capped(stage(risk, "risk"), [F.desc("total_notional_eur"), "counterparty", "commodity"])


_LAKE = f"{Q.SCORED},\n{Q.PORTFOLIO.removeprefix(Q.SILVER + ',')}"


def _write_lake(spark, sf_dir) -> str:
    """The four Gold tables below a lake root."""
    out = scratch_path(spark, "lake")
    trades = stage(M.silver_trades(spark, sf_dir), "silver")
    pnl = stage(M.valued_trades(spark, sf_dir, trades), "gold")
    tables = {"trades_pnl": pnl, "counterparty_risk": gold.counterparty_risk(pnl), "portfolio_summary": gold.portfolio_summary(pnl),
              "trade_surveillance": surrogate_scored(spark, sf_dir, trades)}
    for name, df in tables.items():
        df.write.parquet(dataset_path(out, name))
    return out


# Columns of the Gold tables, written out for the comparison.
_LISTING = {
    "trades_pnl": ("commodity (string), trade_id (string), trader_id (string), counterparty (string), buy_sell (string), volume_mw (double), "
                   "price_eur_mwh (double), delivery_start (timestamp), delivery_end (timestamp), created_at (timestamp), "
                   "latest_market_price (double), market_price_as_of (timestamp), effective_market_price (double), "
                   "notional_value_eur (double), mtm_value_eur (double), unrealized_pnl_eur (double)", "count(*) FROM pnl"),
    "counterparty_risk": ("counterparty (string), commodity (string), trade_count (bigint), total_volume_mw (double), total_notional_eur (double), "
                          "total_mtm_eur (double), net_unrealized_pnl_eur (double)", "count(*) FROM (SELECT DISTINCT counterparty, commodity FROM pnl)"),
    "portfolio_summary": ("commodity (string), total_trades (bigint), net_volume_mw (double), portfolio_notional_eur (double), "
                          "total_portfolio_pnl_eur (double)", "count(*) FROM portfolio"),
    "trade_surveillance": ("trade_id (string), counterparty (string), commodity (string), buy_sell (string), volume_mw (double), price_eur_mwh (double), "
                           "anomaly_score (double), is_anomaly (boolean), risk_band (string), top_reason (string)", "count(*) FROM scored"),
}


@query(Q.with_(_LAKE, " UNION ALL ".join(
    f"SELECT '{name}' AS name, '{columns}' AS columns, (SELECT {rows}) AS rows" for name, (columns, rows) in _LISTING.items())))
def catalog_listing(spark, sf_dir):
    """All Gold tables of a lake with their columns and rows."""
    return serving.list_lake(spark, _write_lake(spark, sf_dir))


@query(Q.with_(_LAKE, """SELECT commodity, total_trades, total_portfolio_pnl_eur, (SELECT count(*) FROM (SELECT DISTINCT counterparty, commodity FROM pnl)) AS books,
(SELECT count(*) FROM pnl) AS trades, (SELECT count(*) FROM scored WHERE is_anomaly) AS alerts, false AS truncated FROM portfolio WHERE total_trades >= 1"""))
def adhoc_statement(spark, sf_dir):
    """A guarded statement with a parameter over all stored Gold tables, and whether there were more rows."""
    rows, more = serving.query_data(
        spark, _write_lake(spark, sf_dir), """SELECT commodity, total_trades, total_portfolio_pnl_eur, (SELECT count(*) FROM counterparty_risk) AS books,
        (SELECT count(*) FROM trades_pnl) AS trades, (SELECT count(*) FROM trade_surveillance WHERE is_anomaly) AS alerts
        FROM portfolio_summary WHERE total_trades >= :least""", {"least": 1})
    return rows.withColumn("truncated", F.lit(more))


@query(Q.with_(Q.SCORED, """SELECT 'market rows accepted' AS measure, CAST((SELECT count(*) FROM events WHERE value BETWEEN -500 AND 4000) AS DOUBLE) AS value
UNION ALL SELECT 'market rows quarantined', (SELECT count(*) FROM events WHERE NOT value BETWEEN -500 AND 4000)
UNION ALL SELECT 'trades accepted', (SELECT count(*) FROM (SELECT trade_id FROM raw GROUP BY trade_id HAVING count(*) = 1))
UNION ALL SELECT 'trades quarantined', (SELECT sum(n) FROM (SELECT count(*) AS n FROM raw GROUP BY trade_id HAVING count(*) > 1))
UNION ALL SELECT 'trades scored', (SELECT count(*) FROM scored)
UNION ALL SELECT 'surveillance alerts', (SELECT count(*) FROM scored WHERE is_anomaly)
UNION ALL SELECT 'alert rate', (SELECT round(count(*) FILTER (is_anomaly) / count(*), 4) FROM scored)"""))
def run_summary(spark, sf_dir):
    market = gates.batch_verdict(gates.route(M.price_series(spark, sf_dir), gates.MARKET_PRICES), "market_prices")
    trades = gates.batch_verdict(gates.route(M.raw_trades(spark, sf_dir), M.MAPPED_TRADES), "trades")
    return serving.run_summary(market, trades, surveillance.alert_rate(surrogate_scored(spark, sf_dir)))
