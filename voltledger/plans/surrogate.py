"""A deterministic stand-in for the model's score, for comparing the serving queries.

It is the min-max scaled distance of a trade's price deviation from the batch mean. It
is not the surveillance model; that is the forest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltledger import settings as S
from voltledger.functions import scores as X
from voltledger.operators.features import feature_baseline, with_features
from voltledger.operators.surveillance import baseline_rows, relative_risk, with_top_reason
from voltledger.plans.market_tables import silver_trades
from voltledger.session import stage

FLAG_SIGMA = 1.6
TRADE_COLUMNS = ("trade_id", "counterparty", "commodity", "buy_sell", "volume_mw", "price_eur_mwh")


def surrogate_scored(spark: SparkSession, sf_dir: str, trades: DataFrame | None = None) -> DataFrame:
    """Scored Silver trades; ``trades`` is the staged Silver table where the caller has it."""
    trades = stage(silver_trades(spark, sf_dir), "silver") if trades is None else trades
    # Only what the result names is written again.
    featured = stage(with_features(trades).select(*TRADE_COLUMNS, "_features"), "featured")
    base = baseline_rows(feature_baseline(featured.select("_features.*")))
    own = base["price_deviation_pct"]
    sigma = X.sigma_shift(F.col("_features.price_deviation_pct"), F.lit(own["mean"]), F.lit(own["std"]))
    shifted = featured.withColumn("_s", sigma)
    # Relative risk ranks low raw values highest, hence the sign.
    ends = shifted.agg(F.struct(F.min(-F.col("_s")).alias("lo"), F.max(-F.col("_s")).alias("hi")).alias("e"))
    rated = shifted.withColumn("_risk", relative_risk(-F.col("_s"), ends.scalar()))
    risk = F.col("_risk")
    reasoned = with_top_reason(rated, {f: F.col(f"_features.{f}") for f in S.FEATURES}, base)
    return reasoned.select(
        *TRADE_COLUMNS,
        F.bround(risk, 4).alias("anomaly_score"), (F.col("_s") > FLAG_SIGMA).alias("is_anomaly"),
        X.risk_band(risk).alias("risk_band"), "top_reason",
    )
