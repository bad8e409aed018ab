"""Mapping of order-style tables onto the trade and price contracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltledger.functions.contracts import TRADES, Contract, matches
from voltledger.operators.gold import latest_price, value_trades
from voltledger.operators.silver import to_silver_trades
from voltledger.operators.upsert import insert_if_absent
from voltledger.session import discard, stage

# Mapped ids carry at least eight digits; longer numbers keep all of theirs.
MAPPED_TRADES: Contract = TRADES.with_field("trade_id", checks=(matches(r"^TRD-\d{8,}\z"),))

# Total order that picks the survivor of a repeated trade id.
SURVIVOR_ORDER = (
    "created_at", "delivery_start", "l_partkey", "l_suppkey", "price_eur_mwh", "volume_mw", "buy_sell",
    "l_discount", "l_tax", "l_returnflag",
)
TRADE_COLUMNS = (
    "trade_id", "trader_id", "counterparty", "commodity", "buy_sell", "volume_mw", "price_eur_mwh",
    "delivery_start", "delivery_end", "created_at",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_trades(spark: SparkSession, sf_dir: str, extra: Sequence[str] = ()) -> DataFrame:
    """lineitem, orders and customer as trades; ids repeat."""
    return _with_texts(_numbered_trades(spark, sf_dir, extra), extra)


def _with_texts(numbered: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Trades with their ids and names in place of the numbers that these are made of; one ``trade_id`` per number."""
    number = F.col("trade_number").cast("string")
    texts = {
        "trade_id": F.concat(F.lit("TRD-"), F.lpad(number, F.greatest(F.length(number), F.lit(8)), F.lit("0"))),
        "trader_id": F.concat(F.lit("TRADER-"), (F.col("l_suppkey") % 10 + 101).cast("string")),
        "commodity": F.when(F.col("l_partkey") % 2 == 0, "POWER").otherwise("NATURAL_GAS"),
    }
    return numbered.select(*[texts.get(c, F.col(c)).alias(c) for c in TRADE_COLUMNS], *extra)


def _numbered_trades(spark: SparkSession, sf_dir: str, extra: Sequence[str]) -> DataFrame:
    """Raw trades with ``trade_number``, ``l_suppkey`` and ``l_partkey`` in the place of the texts made of them."""
    lines, orders, customers = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer"))
    # Customers meet the orders, a quarter as many rows as the lines.
    named = orders.join(customers.select("c_custkey", "c_name"), orders.o_custkey == customers.c_custkey)
    joined = lines.join(named, lines.l_orderkey == named.o_orderkey)
    start = F.col("l_shipdate").cast("timestamp")
    hours = F.get(F.array(*[F.lit(h).cast("bigint") for h in (1, 4, 12, 24)]), F.col("l_linenumber") % 4)
    return joined.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("trade_number"),
        F.replace("c_name", F.lit("#"), F.lit("_")).alias("counterparty"),
        F.when(F.col("l_linestatus") == "O", "BUY").otherwise("SELL").alias("buy_sell"),
        F.col("l_quantity").alias("volume_mw"),
        # Whole cents over 100 000: the double nearest to the exact five-decimal price.
        (F.rint(F.col("l_extendedprice") * 100) / 100_000).alias("price_eur_mwh"),
        start.alias("delivery_start"),
        F.timestamp_micros(F.unix_micros(start) + hours * 3_600_000_000).alias("delivery_end"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
        *dict.fromkeys(("l_suppkey", "l_partkey", *extra)),
    )


def silver_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = [c for c in SURVIVOR_ORDER if c.startswith("l_")]
    # Numbers are sorted and shuffled faster than the texts made of them.
    return _with_texts(to_silver_trades(_numbered_trades(spark, sf_dir, extra), SURVIVOR_ORDER, "trade_number"))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trades with one row per id, as the key of their source demands, written once."""
    extra = [c for c in SURVIVOR_ORDER if c.startswith("l_")]
    # The joined rows are written before they are shuffled again, by number and without the texts made of numbers.
    numbered = stage(_numbered_trades(spark, sf_dir, extra).withColumnRenamed("trade_number", "trade_id"), "numbered")
    firsts = insert_if_absent(numbered, numbered.limit(0), "trade_id", SURVIVOR_ORDER)
    trades = stage(_with_texts(firsts.withColumnRenamed("trade_id", "trade_number")), "ledger")
    discard(numbered)
    return trades


def price_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as price series items."""
    return table(spark, sf_dir, "events").select(
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp_ms"),
        F.col("value").cast("decimal(18,2)").cast("double").alias("price_eur_mwh"),
    )


def market_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as Silver prices at full time resolution, all of them power."""
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("timestamp"), F.lit("POWER").alias("commodity"),
        F.col("value").cast("decimal(18,2)").cast("double").alias("price_eur_mwh"),
    )


def unit_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price per unit of every line as a price batch; about a quarter of it breaks the price limit."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("timestamp_ms"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price_eur_mwh"),
    )


def valued_trades(spark: SparkSession, sf_dir: str, trades: DataFrame | None = None) -> DataFrame:
    """Silver trades (mapped here unless given) at the newest market price."""
    trades = silver_trades(spark, sf_dir) if trades is None else trades
    return value_trades(trades, latest_price(market_prices(spark, sf_dir)))
