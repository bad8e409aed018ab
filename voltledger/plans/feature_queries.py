"""Features, baseline, drift and reasons."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltledger import settings as S
from voltledger.functions.texts import rounded
from voltledger.operators import features as X
from voltledger.operators import surveillance
from voltledger.operators.quantiles import exact_quantiles
from voltledger.plans import market_tables as M
from voltledger.plans import sql_parts as Q
from voltledger.plans.catalog import query
from voltledger.plans.surrogate import surrogate_scored
from voltledger.session import stage
from voltledger.sources import sinks

# Prices that shift the book away from its own medians.
LIVE_PRICES = {"POWER": 10.0, "NATURAL_GAS": 42.5}
_LIVE = Q.features(Q.features(), "silver", "live", "CASE b.commodity WHEN 'POWER' THEN 10.0 ELSE 42.5 END")


def _silver(spark, sf_dir):
    return stage(M.silver_trades(spark, sf_dir), "silver")


@query(Q.with_(Q.features(), "SELECT trade_id, round(CAST(ref AS DOUBLE), 6) AS reference_price FROM feats_ref"))
def reference_price(spark, sf_dir):
    return X.reference_price(_silver(spark, sf_dir)).select("trade_id", rounded(F.col("reference_price"), 6).alias("reference_price"))


@query(Q.with_(Q.features(reference="CASE b.commodity WHEN 'POWER' THEN 14.5 ELSE m.median_price END"), "SELECT trade_id, round(CAST(ref AS DOUBLE), 6) AS reference_price FROM feats_ref"))
def scalar_reference_price(spark, sf_dir):
    """A single market price counts for power only."""
    return X.reference_price(_silver(spark, sf_dir), 14.5).select("trade_id", rounded(F.col("reference_price"), 6).alias("reference_price"))


@query(Q.with_(Q.features(), "SELECT trade_id, round(cp_share, 6) AS counterparty_trade_share, round(tr_share, 6) AS trader_trade_share FROM feats_ref"))
def concentration(spark, sf_dir):
    shares = X.concentration(_silver(spark, sf_dir), "counterparty", "cp")
    return X.concentration(shares, "trader_id", "tr").select(
        "trade_id", rounded(F.col("cp"), 6).alias("counterparty_trade_share"), rounded(F.col("tr"), 6).alias("trader_trade_share"))


@query(Q.with_(Q.features(), "SELECT trade_id, " + ", ".join(f"round(CAST({f} AS DOUBLE), 6) AS {f}" for f in Q.FEATURE_NAMES) + " FROM feats"))
def trade_features(spark, sf_dir):
    return X.build_features(_silver(spark, sf_dir), keep=["trade_id"]).select("trade_id", *[rounded(F.col(f), 6).alias(f) for f in S.FEATURES])


@query(Q.with_(f"{Q.features()},\n{Q.baseline()}", "SELECT feature, round(mean, 6) AS mean, round(std, 6) AS std, round(median, 6) AS median FROM base"))
def feature_baseline(spark, sf_dir):
    features = stage(X.build_features(_silver(spark, sf_dir)), "features")
    return X.feature_baseline(features).select("feature", *[F.round(c, 6).alias(c) for c in ("mean", "std", "median")])


DRIFT = f"{_LIVE},\n{Q.baseline()},\n{Q.baseline('live', 'now')}"
DRIFT_ROWS = f"""SELECT base.feature, round(base.mean, 4) AS baseline_mean, round(now.mean, 4) AS current_mean,
  round({Q.sigma('now.mean', 'base.mean', 'base.std')}, 2) AS shift_sigma, base.std <= 0.000001 AS was_constant_in_training
FROM base JOIN now ON base.feature = now.feature WHERE {Q.sigma('now.mean', 'base.mean', 'base.std')} > 2.0"""


def _drift(spark, sf_dir):
    trades = _silver(spark, sf_dir)
    counts = X.feature_counts(trades)
    baseline = X.feature_baseline(stage(X.build_features(trades, counts=counts), "features"))
    return surveillance.drift_report(X.build_features(trades, LIVE_PRICES, counts=counts), baseline)


@query(Q.with_(DRIFT, DRIFT_ROWS))
def drift_report(spark, sf_dir):
    return _drift(spark, sf_dir)


@query(Q.with_(
    DRIFT,
    f"SELECT (SELECT count(*) FROM silver) AS n_scored, string_agg(feature, ',' ORDER BY feature) AS drifted_features FROM ({DRIFT_ROWS})"))
def drift_record(spark, sf_dir):
    """The stored drift report: rows scored and drifted features."""
    scored = _silver(spark, sf_dir).withColumn("is_anomaly", F.lit(False))
    return sinks.drift_summary(_drift(spark, sf_dir), scored).select(
        "n_scored", F.array_join(F.transform("drifted_features", lambda d: d["feature"]), ",").alias("drifted_features"))


@query(Q.with_(f"{_LIVE},\n{Q.baseline()},\n{Q.reasons('live')}", "SELECT trade_id, top_reason FROM reasons"))
def top_reason(spark, sf_dir):
    """Why each trade of the shifted book stands out against the unshifted baseline."""
    trades = _silver(spark, sf_dir)
    counts = X.feature_counts(trades)
    base = surveillance.baseline_rows(X.feature_baseline(stage(X.build_features(trades, counts=counts), "features")))
    live = X.build_features(trades, LIVE_PRICES, keep=["trade_id"], counts=counts)
    return surveillance.with_top_reason(live, {f: F.col(f) for f in S.FEATURES}, base).select("trade_id", "top_reason")


@query(Q.with_(Q.PNL, """SELECT 'ALL' AS book, CAST(median(CAST(market AS DOUBLE)) AS DOUBLE) AS market_price FROM pnl
UNION ALL SELECT commodity, median(CAST(market AS DOUBLE)) FROM pnl GROUP BY commodity"""))
def scoring_market_price(spark, sf_dir):
    """Effective market price of the mixed book and of each commodity."""
    gold = stage(M.valued_trades(spark, sf_dir), "gold")
    mixed = exact_quantiles(gold, "effective_market_price", alias="market_price").select(F.lit("ALL").alias("book"), "market_price")
    return mixed.unionByName(surveillance.commodity_market_prices(gold).withColumnRenamed("commodity", "book"))


@query(Q.with_(Q.SCORED, "SELECT * FROM scored"))
def risk_bands(spark, sf_dir):
    return surrogate_scored(spark, sf_dir)
