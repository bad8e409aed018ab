"""Bronze to Silver: typed, deduplicated prices and trades."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TIMESTAMP_COLUMNS = ("delivery_start", "delivery_end", "created_at")


def first_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence) -> DataFrame:
    """One row per key: the first in ``order``.

    The planner limits each key to one row per task before the shuffle, so a key
    with any number of copies stays harmless.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ranked = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(ranked)).where("_rn = 1").drop("_rn")


def to_silver_prices(series: DataFrame, commodity: str = "POWER") -> DataFrame:
    """(timestamp_ms, price_eur_mwh) rows to one price per timestamp.

    A payload's own commodity is not trusted; the series is what the caller says it is.
    Of several prices for one timestamp the lowest survives.
    """
    prices = series.select(
        F.timestamp_millis(F.col("timestamp_ms").try_cast("bigint")).alias("timestamp"),
        F.lit(commodity).alias("commodity"),
        F.col("price_eur_mwh").try_cast("double").alias("price_eur_mwh"),
    ).where(F.col("price_eur_mwh").isNotNull())
    return first_per_key(prices, "timestamp", ["price_eur_mwh"])


def to_silver_trades(trades: DataFrame, order: Sequence | None = None, key: str = "trade_id") -> DataFrame:
    """Typed trades, one per ``key``; without ``order`` all columns decide the survivor."""
    typed = trades
    for c in ("volume_mw", "price_eur_mwh"):
        typed = typed.withColumn(c, F.col(c).try_cast("double"))
    for c in TIMESTAMP_COLUMNS:
        if c in trades.columns:
            typed = typed.withColumn(c, F.col(c).try_cast("timestamp"))
    return first_per_key(typed, key, order or [c for c in trades.columns if c != key])
