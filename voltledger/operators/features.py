"""Surveillance features. Training and scoring both call :func:`build_features`."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltledger import settings as S
from voltledger.operators import quantiles
from voltledger.operators.joins import lookup_join
from voltledger.session import stage

# One POWER price, a price per commodity, or a table (commodity, market_price).
MarketPrice = float | Mapping[str, float] | DataFrame | None


def number(c: str) -> Column:
    """Lenient parse: anything that is not a number counts as 0."""
    value = F.col(c).try_cast("double")
    return F.coalesce(F.nullif(value, F.lit(float("nan"))), F.lit(0.0))


def finite(c: Column) -> Column:
    """0 for null, NaN and infinite values; NaN counts as larger than infinity."""
    return F.when(F.abs(c) < float("inf"), c).otherwise(F.lit(0.0))


def _explicit(market_price: MarketPrice) -> dict[str, float]:
    """A single number is the POWER price only; zero, NaN and missing entries do not count."""
    if market_price is None:
        return {}
    if isinstance(market_price, Mapping):
        return {k: float(v) for k, v in market_price.items() if v}
    value = float(market_price)
    return {"POWER": value} if value not in (0.0, float("inf"), float("-inf")) and value == value else {}


def _per_commodity(values: Mapping[str, float]) -> Column:
    c = F.lit(None).cast("double")
    for commodity, value in values.items():
        c = F.when(F.col("commodity") == commodity, F.lit(float(value))).otherwise(c)
    return c


def _nonzero(c: Column) -> Column:
    return F.nullif(c, F.lit(0.0))


def book_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame | None:
    """(column, entity, rows) for all ``columns`` in one pass, nulls included, written once."""
    if not columns:
        return None
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("entity")) for c in columns])
    counted = df.select(F.explode(pairs).alias("e")).groupBy("e.column", "e.entity").agg(F.count("*").alias("rows"))
    return stage(counted, "entity-counts")


def _counts_of(df: DataFrame, column: str, counts: DataFrame | None) -> DataFrame:
    """Rows per entity of ``column``, nulls included."""
    counts = book_counts(df, [column]) if counts is None else counts
    return counts.where(F.col("column") == column).select(F.col("entity").alias(column), F.col("rows").alias("_held"))


def price_levels(df: DataFrame, market_price: MarketPrice = None, counts: DataFrame | None = None,
                 accuracy: int | None = None) -> tuple[DataFrame | None, float]:
    """Written (commodity, reference_price) rows, and the price of every row they do not cover."""
    table = None
    if isinstance(market_price, DataFrame):
        table, market_price = market_price, None
    explicit = _explicit(market_price)
    prices = df.withColumn("_price", number("price_eur_mwh"))

    def global_median() -> float | None:
        return quantiles.quantile(prices, "_price", alias="m", accuracy=accuracy).first()["m"]

    if "commodity" not in df.columns:
        level = explicit.get("POWER")
        if level is None:
            level = global_median()
            level = S.DEFAULT_MARKET_LEVEL["POWER"] if level is None else level
        return None, float(level or 1.0)

    sizes = _counts_of(df, "commodity", counts)
    known = _per_commodity(explicit)
    # A median is needed only where no price was given.
    open_prices = prices.where(known.isNull()) if explicit else prices
    medians = quantiles.quantile(open_prices, "_price", ["commodity"], alias="_median", accuracy=accuracy)
    levels = sizes.join(medians, "commodity", "left")
    if table is not None:
        known_prices = table.select("commodity", F.col("market_price").cast("double").alias("_known"))
        levels, known = levels.join(known_prices, "commodity", "left"), _nonzero(F.col("_known"))
    resolved = F.coalesce(known, _nonzero(F.col("_median")), _per_commodity(S.DEFAULT_MARKET_LEVEL)).alias("reference_price")
    # Rows that nothing else covers take the median of the whole book; that pass runs only if there are any.
    levels = stage(levels.select("commodity", resolved), "price-levels")
    missing = not levels.where(F.col("reference_price").isNull()).isEmpty()
    return levels.where(F.col("commodity").isNotNull()), float((global_median() if missing else None) or 1.0)


def _at_levels(df: DataFrame, levels: DataFrame | None, fallback: float) -> DataFrame:
    if levels is None:
        return df.withColumn("reference_price", F.lit(fallback))
    return lookup_join(df, levels, "commodity").withColumn("reference_price", F.coalesce("reference_price", F.lit(fallback)))


def reference_price(df: DataFrame, market_price: MarketPrice = None, counts: DataFrame | None = None,
                    accuracy: int | None = None) -> DataFrame:
    """``df`` plus ``reference_price``: explicit price, batch median, default level, global median, 1.

    Medians are exact, or sketched with ``accuracy`` (``quantiles.quantile``).
    """
    return _at_levels(df, *price_levels(df, market_price, counts, accuracy))


def concentration(df: DataFrame, column: str, alias: str, counts: DataFrame | None = None) -> DataFrame:
    """``df`` plus how many times its fair share of rows each entity holds (1.0 = equal split)."""
    if column not in df.columns:
        return df.withColumn(alias, F.lit(0.0))
    held = _counts_of(df, column, counts)
    entities = held.agg(F.count(column)).scalar()
    total = held.agg(F.sum("_held")).scalar()
    ratio = F.try_divide(F.col("_held"), total) / F.try_divide(F.lit(1.0), entities)
    known = F.col(column).isNotNull()
    return (
        lookup_join(df, held.where(known), column, written=True)
        .withColumn(alias, F.coalesce(ratio, F.lit(0.0))).drop("_held")
    )


def build_features(df: DataFrame, market_price: MarketPrice = None, keep: Sequence[str] = (), accuracy: int | None = None,
                   counts: DataFrame | None = None) -> DataFrame:
    """The nine features in fixed order, all finite, after the columns in ``keep``.

    Features share names with trade columns, so kept columns of those names are not allowed.
    """
    return with_features(df, market_price, accuracy, counts).select(*keep, "_features.*")


def feature_counts(df: DataFrame) -> DataFrame | None:
    """Rows per entity that features of ``df`` need; at several market prices they are counted once."""
    return book_counts(df, [c for c in ("commodity", "counterparty", "trader_id") if c in df.columns])


# What features take from the whole book; all else is worked out from the row.
LOOKED_UP = ("reference_price", "_cp_share", "_tr_share")


def looked_up(df: DataFrame, levels: DataFrame | None, fallback: float, counts: DataFrame | None) -> DataFrame:
    """``df``, a book or some of its rows, plus the ``LOOKED_UP`` columns from the whole book's levels and counts."""
    out = _at_levels(df, levels, fallback)
    out = concentration(out, "counterparty", "_cp_share", counts)
    return concentration(out, "trader_id", "_tr_share", counts)


def with_features(df: DataFrame, market_price: MarketPrice = None, accuracy: int | None = None, counts: DataFrame | None = None) -> DataFrame:
    """``df`` plus ``_features``, a struct of the nine doubles; ``counts`` are its ``feature_counts``, taken here unless given."""
    counts = feature_counts(df) if counts is None else counts
    return row_features(looked_up(df, *price_levels(df, market_price, counts, accuracy), counts)).drop(*LOOKED_UP)


def row_features(df: DataFrame) -> DataFrame:
    """``df``, which has the ``LOOKED_UP`` columns, plus ``_features``: no row but its own is looked at."""
    # Columns of their own: values of several features are worked out once, and the generated code stays small enough
    # (8000 bytes a method) for the JVM to compile it.
    ref = F.col("reference_price")
    out = df.withColumns({"_volume": number("volume_mw"), "_price": number("price_eur_mwh")})
    out = out.withColumn("_deviation", F.try_divide(F.col("_price") - ref, F.abs(ref)) * 100.0)
    volume, price, deviation = F.col("_volume"), F.col("_price"), F.col("_deviation")
    if {"delivery_start", "delivery_end"} <= set(df.columns):
        start, end = (F.unix_micros(F.col(c).try_cast("timestamp")) for c in ("delivery_start", "delivery_end"))
        hours = (end - start) / 3.6e9
    else:
        hours = F.lit(0.0)
    values = {
        "volume_mw": volume,
        "price_eur_mwh": price,
        "notional_value_eur": volume * price,
        "price_deviation_pct": deviation,
        "abs_price_deviation_pct": F.abs(deviation),
        "delivery_hours": hours,
        "counterparty_trade_share": F.col("_cp_share"),
        "trader_trade_share": F.col("_tr_share"),
        "is_off_market": F.when(~F.isnan(deviation) & (F.abs(deviation) > S.OFF_MARKET_PCT), 1.0).otherwise(0.0),
    }
    features = F.struct(*[finite(values[name]).alias(name) for name in S.FEATURES])
    return out.withColumn("_features", features).drop("_volume", "_price", "_deviation")


# Bytes that a counterparty and its count take.  Counts too large to be broadcast make the rows move: so many at a
# time, in so many portions at most.
_KEY_BYTES, _PORTION_ROWS, _PORTIONS = 64, 16_000_000, 8


def portions(df: DataFrame, counts: DataFrame | None) -> list[DataFrame]:
    """A written book in parts by counterparty, so that the shuffle of a lookup holds one part's rows and not all."""
    if counts is None or "counterparty" not in df.columns:
        return [df]
    held = _counts_of(df, "counterparty", counts).agg(F.count("*").alias("keys"), F.sum("_held").alias("rows")).first()
    sent = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    n = min(_PORTIONS, -(-(held["rows"] or 0) // _PORTION_ROWS)) if held["keys"] * _KEY_BYTES > sent else 1
    # Not the hash that shuffles use: its remainders would leave some of their partitions empty.
    part = F.pmod(F.xxhash64("counterparty"), F.lit(n))
    return [df.where(part == i) for i in range(n)] if n > 1 else [df]


def long_features(features: DataFrame) -> DataFrame:
    """(feature number, value) rows."""
    pairs = F.array(*[F.struct(F.lit(i).alias("feature"), F.col(f).alias("value")) for i, f in enumerate(S.FEATURES)])
    return features.select(F.explode(pairs).alias("e")).select("e.*")


def feature_baseline(features: DataFrame, accuracy: int | None = None) -> DataFrame:
    """(feature, mean, std, median) over the training batch; medians exact, or sketched with ``accuracy``."""
    entries = [
        F.struct(F.lit(i).alias("_f"), F.lit(f).alias("feature"), F.avg(f).alias("mean"),
                 F.coalesce(F.stddev_samp(f), F.lit(0.0)).alias("std"))
        for i, f in enumerate(S.FEATURES)
    ]
    moments = features.agg(F.array(*entries).alias("all")).select(F.explode("all").alias("e")).select("e.*")
    medians = quantiles.quantile(long_features(features), "value", ["feature"], alias="median", accuracy=accuracy)
    return moments.join(medians.withColumnRenamed("feature", "_f"), "_f", "left").select("feature", "mean", "std", "median")


def feature_means(features: DataFrame) -> DataFrame:
    """(feature, current_mean); one aggregation over the rows, then nine rows."""
    means = features.agg(*[F.avg(f).alias(f) for f in S.FEATURES])
    return means.select(
        F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("current_mean")) for f in S.FEATURES])).alias("e")
    ).select("e.*")
