"""Trade surveillance: train, score, explain, watch for drift."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltledger import settings as S
from voltledger.functions import scores as X
from voltledger.operators.features import (
    LOOKED_UP, MarketPrice, build_features, feature_baseline, feature_counts, feature_means, looked_up, portions, price_levels,
    row_features,
)
from voltledger.operators.forest import Forest, fit_forest, score_column, score_metrics
from voltledger.operators.quantiles import quantile
from voltledger.session import stage

NO_REASON = "n/a"


@dataclass
class Model:
    forest: Forest
    baseline: DataFrame
    metrics: DataFrame


def train(trades: DataFrame, key: Sequence[str] = ("trade_id",), trained_at: str = "unknown", accuracy: int | None = None, **fit) -> Model:
    """Learn what normal trading looks like; medians are exact, or sketched with ``accuracy``."""
    features = stage(build_features(trades, keep=key, accuracy=accuracy), "train-features")
    forest, raw = fit_forest(features, key, keep=(), **fit)
    forest.trained_at = trained_at
    return Model(forest, stage(feature_baseline(features, accuracy), "baseline"), stage(score_metrics(raw, forest), "metrics"))


def commodity_market_prices(gold: DataFrame, accuracy: int | None = None) -> DataFrame:
    """(commodity, market_price) as carried by the valued trades."""
    return quantile(gold, "effective_market_price", ["commodity"], alias="market_price", accuracy=accuracy)


def scalar_market_price(gold: DataFrame, accuracy: int | None = None) -> float | None:
    """Median effective price over the whole mixed book: the single-number form, power only."""
    return quantile(gold, "effective_market_price", alias="m", accuracy=accuracy).first()["m"]


def score(trades: DataFrame, model: Model, market_price: MarketPrice = None) -> DataFrame:
    """Every input column plus anomaly_score, is_anomaly, risk_band, model_version, top_reason.

    Valued trades carry their market price, so without an explicit one it is taken per
    commodity from there.
    """
    return rate(raw_scores(trades, model, market_price), model)


def raw_scores(trades: DataFrame, model: Model, market_price: MarketPrice = None) -> DataFrame:
    """Trades with the forest's ``_raw`` score, written once, and ``_features``: the range of
    the scores, the rated table and the drift report all read it."""
    if market_price is None and {"effective_market_price", "commodity"} <= set(trades.columns):
        market_price = commodity_market_prices(trades)
    counts = feature_counts(trades)
    levels, fallback = price_levels(trades, market_price, counts)
    # Python sees the nine doubles only; the trade's other columns stay in the JVM.
    flat = {f"_f_{f}": F.col(f"_features.{f}") for f in S.FEATURES}
    raw = score_column(trades.sparkSession, model.forest, list(flat))
    # What features take from the book is written, not the features: they follow from it and the trade.
    parts = [
        row_features(looked_up(part, levels, fallback, counts)).withColumns(flat).withColumn("_raw", raw).drop(*flat, "_features")
        for part in portions(trades, counts)
    ]
    return row_features(stage(parts[0], "scored", *parts[1:])).drop(*LOOKED_UP)


def rate(scored: DataFrame, model: Model) -> DataFrame:
    """Raw scores to risk relative to the batch, flag, band and reason."""
    ends = scored.agg(F.struct(F.min("_raw").alias("lo"), F.max("_raw").alias("hi")).alias("ends"))
    rated = scored.withColumn("_risk", relative_risk(F.col("_raw"), ends.scalar())).withColumns({
        "anomaly_score": F.bround("_risk", 4),
        "is_anomaly": F.col("_raw") < F.lit(model.forest.offset),
        "risk_band": X.risk_band(F.col("_risk")),
        "model_version": F.lit(model.forest.trained_at),
    })
    values = {f: F.col(f"_features.{f}") for f in S.FEATURES}
    return with_top_reason(rated, values, baseline_rows(model.baseline)).drop("_risk", "_raw", "_features")


def relative_risk(raw: Column, ends: Column) -> Column:
    """0 for the most normal row of the batch, 1 for the most isolated; 0 throughout if all are equal."""
    lo, hi = ends.getField("lo"), ends.getField("hi")
    return F.when(hi > lo, (hi - raw) / F.nullif(hi - lo, F.lit(0.0))).otherwise(F.lit(0.0))


def baseline_rows(baseline: DataFrame) -> dict[str, Mapping[str, float]]:
    """The baseline as literals: exactly one row per feature it covers."""
    held = baseline.where(F.col("feature").isin(*S.FEATURES))
    # One row more than there may be shows a table with two baselines without reading it all.
    rows = held.limit(len(S.FEATURES) + 1).collect()
    found = {r["feature"]: r.asDict() for r in rows}
    if len(found) != len(rows):
        raise ValueError("the baseline holds a feature more than once")
    return found


def with_top_reason(
    df: DataFrame, values: Mapping[str, Column], baseline: Mapping[str, Mapping[str, float]], alias: str = "top_reason"
) -> DataFrame:
    """``df`` plus the feature farthest from its baseline, in words; of equal ones the first in feature order."""
    covered = [name for name in S.FEATURES if baseline.get(name) is not None]
    if not covered:
        return df.withColumn(alias, F.lit(NO_REASON))
    # Mean and spread are literals: each sentence has one form, and what it says of training is worked out once per query.
    mean, std = ({name: F.lit(float(baseline[name][k] or 0.0)) for name in covered} for k in ("mean", "std"))
    shifts = {f"_shift_{name}": X.sigma_shift(values[name], mean[name], std[name]) for name in covered}
    shifted = df.withColumns(shifts).withColumn("_worst", F.greatest(*shifts) if len(shifts) > 1 else F.col(*shifts))
    farthest = F.coalesce(*[F.when(F.col(f"_shift_{name}") == F.col("_worst"), F.lit(name)) for name in covered])
    named = shifted.withColumn("_name", farthest)
    # Columns of their own: the sentences refer to them many times, the search runs once.
    reason = X.far_off(F.col("_name"), F.col("_worst"))
    for name in covered:
        if X.constant_in_training(baseline[name]["std"]):
            seen = X.never_seen(F.lit(name), values[name], mean[name])
            reason = F.when(F.col("_name") == name, seen).otherwise(reason)
    return named.withColumn(alias, F.when(F.col("_worst") > 0, reason).otherwise(F.lit(NO_REASON))).drop("_worst", "_name", *shifts)


def drift_report(features: DataFrame, baseline: DataFrame, threshold: float = S.DRIFT_SIGMA) -> DataFrame:
    """Features whose batch mean has left the training baseline."""
    current = feature_means(features)
    base = baseline_rows(baseline)
    held = baseline.sparkSession.createDataFrame([(f, r["mean"], r["std"]) for f, r in base.items()], "feature string, mean double, std double")
    joined = current.join(F.broadcast(held), "feature")
    shift = X.sigma_shift(F.col("current_mean"), F.col("mean"), F.col("std"))
    return joined.where(shift > threshold).select(
        "feature",
        F.round(F.coalesce("mean", F.lit(0.0)), 4).alias("baseline_mean"),
        F.round("current_mean", 4).alias("current_mean"),
        F.round(shift, 2).alias("shift_sigma"),
        X.was_constant(F.col("std")).alias("was_constant_in_training"),
    )


def alert_rate(scored: DataFrame) -> DataFrame:
    flagged = F.count_if("is_anomaly")
    return scored.agg(
        F.count("*").alias("scored"), flagged.alias("flagged"),
        F.round(flagged / F.greatest(F.count("*"), F.lit(1)), 4).alias("alert_rate"),
    )
