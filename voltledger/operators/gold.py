"""Silver to Gold: valuation, counterparty exposure, portfolio."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltledger import settings as S
from voltledger.functions import money
from voltledger.operators.joins import lookup_join
from voltledger.session import stage


def latest_price(prices: DataFrame) -> DataFrame:
    """Newest price per commodity; the lowest price breaks a tie.

    One aggregation that sends one row per task and commodity.  Prices that are null or NaN lose ties.
    """
    price = F.col("price_eur_mwh")
    newest = F.max(F.struct("timestamp", price.isNotNull(), ~F.isnan(price.cast("double")), (-price).alias("low"), price.alias("price")))
    known = prices.where(F.col("commodity").isNotNull() & F.col("timestamp").isNotNull())
    return known.groupBy("commodity").agg(newest.alias("n")).select(
        "commodity", F.col("n.price").alias("latest_market_price"), F.col("n.timestamp").alias("market_price_as_of"))


def fallback_price(
    market_price: Column, commodity: Column, gas: float = S.GAS_BENCHMARK, power: float = S.POWER_BENCHMARK
) -> Column:
    """Market price, else the gas benchmark for gas and the power benchmark for everything else."""
    return F.coalesce(market_price, F.when(commodity == "NATURAL_GAS", F.lit(gas)).otherwise(F.lit(power)))


def value_trades(trades: DataFrame, latest: DataFrame) -> DataFrame:
    """Trades with notional, mark-to-market and signed unrealised profit or loss in EUR."""
    # Written first: the planner then knows that it is small, and no trade is shuffled for it.
    joined = lookup_join(trades, stage(latest, "latest-price"), "commodity")
    market = fallback_price(F.col("latest_market_price"), F.col("commodity"))
    volume, agreed, now = money.volume("volume_mw"), money.price("price_eur_mwh"), money.price("effective_market_price")
    pnl = (
        F.when(F.col("buy_sell") == "BUY", volume * (now - agreed))
        .when(F.col("buy_sell") == "SELL", volume * (agreed - now))
        .otherwise(F.lit(0).cast(money.CENTS_TYPE))
    )
    return joined.withColumn("effective_market_price", market).withColumns({
        "notional_value_eur": money.cents(volume * agreed).cast("double"),
        "mtm_value_eur": money.cents(volume * now).cast("double"),
        "unrealized_pnl_eur": money.cents(pnl).cast("double"),
    })


def counterparty_risk(pnl: DataFrame) -> DataFrame:
    return pnl.groupBy("counterparty", "commodity").agg(
        F.count("trade_id").alias("trade_count"),
        money.total("volume_mw").alias("total_volume_mw"),
        money.total("notional_value_eur").alias("total_notional_eur"),
        money.total("mtm_value_eur").alias("total_mtm_eur"),
        money.total("unrealized_pnl_eur").alias("net_unrealized_pnl_eur"),
    )


def portfolio_summary(pnl: DataFrame) -> DataFrame:
    """Per commodity. ``net_volume_mw`` adds buys and sells alike; the name is kept."""
    return pnl.groupBy("commodity").agg(
        F.count("trade_id").alias("total_trades"),
        money.total("volume_mw").alias("net_volume_mw"),
        money.total("notional_value_eur").alias("portfolio_notional_eur"),
        money.total("unrealized_pnl_eur").alias("total_portfolio_pnl_eur"),
    )


def valuation_terms(pnl: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """The arithmetic of each valuation, spelled out."""
    formula = F.when(F.col("buy_sell") == "BUY", "volume x (market - agreed)").otherwise("volume x (agreed - market)")
    return pnl.select(
        "trade_id", *columns, "buy_sell", "commodity", "volume_mw", "price_eur_mwh", "effective_market_price",
        "notional_value_eur", "mtm_value_eur", formula.alias("pnl_formula"), "unrealized_pnl_eur",
    )
