"""Read-only questions over the Gold tables. Every function returns a DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voltledger import settings as S
from voltledger.functions.statements import classify_sql
from voltledger.operators import guard
from voltledger.operators.guard import StatementRefused
from voltledger.sources import versions
from voltledger.sources.tables import dataset_path, read_dataset

SUSPICIOUS_COLUMNS = ("trade_id", "counterparty", "commodity", "buy_sell", "volume_mw",
                      "price_eur_mwh", "anomaly_score", "risk_band", "top_reason")


def _limit(asked: int, most: int) -> int:
    if asked < 0:
        raise ValueError("limit must not be negative")
    return min(asked, most)


def present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only those of ``columns`` that exist, in that order."""
    return df.select(*[c for c in columns if c in df.columns])


def list_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(name, columns, rows) of each table."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("name"),
            F.lit(", ".join(f"{f.name} ({f.dataType.simpleString()})" for f in df.schema)).alias("columns"),
            "rows",
        )
        for name, df in tables.items()
    ])


def list_lake(spark: SparkSession, root: str) -> DataFrame:
    """(name, columns, rows) of the Gold tables that exist below a lake root."""
    found = {name: read_dataset(spark, root, name) for name in S.GOLD_DATASETS
             if versions.holds_table(spark, dataset_path(root, name))}
    return list_tables(found) if found else spark.createDataFrame([], "name string, columns string, rows long")


def top_counterparty_exposure(risk: DataFrame, limit: int = 10) -> DataFrame:
    return (
        risk.select("counterparty", "commodity", "trade_count", "total_notional_eur", "total_mtm_eur", "net_unrealized_pnl_eur")
        .orderBy(F.desc("total_notional_eur"), "counterparty", "commodity")
        .limit(_limit(limit, S.MAX_EXPOSURE_ROWS))
    )


def exposure_by_counterparty(risk: DataFrame) -> DataFrame:
    """Total exposure per counterparty over all commodities, largest first."""
    exposure = F.sum(F.col("total_notional_eur").cast("decimal(28,2)")).cast("double")
    return risk.groupBy("counterparty").agg(exposure.alias("exposure")).orderBy(F.desc("exposure"), "counterparty")


def suspicious_trades(scored: DataFrame, min_score: float = 0.5, limit: int = 20) -> DataFrame:
    """Highest scores first, at or above ``min_score``."""
    return (
        present(scored.where(F.col("anomaly_score") >= F.lit(min_score)), SUSPICIOUS_COLUMNS)
        .orderBy(F.desc("anomaly_score"), "trade_id")
        .limit(_limit(limit, S.MAX_SUSPICIOUS_ROWS))
    )


def worst_trade(scored: DataFrame) -> DataFrame:
    return suspicious_trades(scored, 0.0, 1)


def flagged_trades(scored: DataFrame, prefix: str | None = None) -> DataFrame:
    flagged = scored.where("is_anomaly")
    return flagged if prefix is None else flagged.where(F.col("trade_id").startswith(prefix))


def recent_trades(trades: DataFrame, n: int = 5) -> DataFrame:
    return (
        trades.select("trade_id", "counterparty", "commodity", "buy_sell", "volume_mw", "price_eur_mwh", "created_at")
        .orderBy(F.desc("created_at"), "trade_id").limit(_limit(n, S.MAX_ROWS))
    )


def kpi_row(portfolio: DataFrame, scored: DataFrame) -> DataFrame:
    """Book totals and the number of surveillance alerts in one row."""
    alerts = scored.agg(F.count_if("is_anomaly")).scalar()

    def exact(c: str):
        return F.coalesce(F.sum(F.col(c).cast("decimal(28,2)")).cast("double"), F.lit(0.0)).alias(c)

    return portfolio.agg(
        F.coalesce(F.sum("total_trades"), F.lit(0)).alias("total_trades"),
        exact("portfolio_notional_eur"), exact("total_portfolio_pnl_eur"),
    ).withColumn("alerts", alerts)


def band_counts(scored: DataFrame) -> DataFrame:
    """Trades per risk band, all four bands present."""
    bands = [label for _, label in S.RISK_BANDS] + [S.LOWEST_BAND]
    dimension = scored.sparkSession.createDataFrame(list(enumerate(bands)), "band_order int, risk_band string")
    counts = scored.groupBy("risk_band").agg(F.count("*").alias("n"))
    return dimension.join(counts, "risk_band", "left").select(
        "band_order", "risk_band", F.coalesce("n", F.lit(0)).alias("trades")
    ).orderBy("band_order")


def band_averages(scored: DataFrame) -> DataFrame:
    average = F.avg("anomaly_score")
    return scored.groupBy("risk_band").agg(F.count("*").alias("trades"), F.round(average, 3).alias("avg_score")).orderBy(F.desc("avg_score"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


def latest_reports(reports: DataFrame) -> DataFrame:
    """The newest report of each kind."""
    newest = W.partitionBy("kind").orderBy(F.desc("stamp"))
    return reports.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn")


_REPORT = ("gates array<struct<rows_clean: bigint, rows_quarantined: bigint>>, overall_passed boolean, n_scored bigint, "
           "drifted_features array<struct<feature: string>>")


def data_quality_status(reports: DataFrame) -> DataFrame:
    """Newest report of each kind, judged: (kind, stamp, passed, rows, findings, features).

    A quality report passes as its gates did; its findings are the rows in quarantine.  A drift report passes
    while no feature has left the baseline; its findings are the features that have.
    """
    read = latest_reports(reports).select("kind", "stamp", F.from_json("report", _REPORT).alias("r"))
    quality = F.col("kind") == "quality"
    names = F.sort_array(F.coalesce("r.drifted_features.feature", F.array().cast("array<string>")))
    total = lambda c: F.aggregate(f"r.gates.{c}", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return read.select(
        "kind", "stamp",
        F.when(quality, F.col("r.overall_passed")).otherwise(F.size(names) == 0).alias("passed"),
        F.when(quality, total("rows_clean")).otherwise(F.col("r.n_scored")).alias("rows"),
        F.when(quality, total("rows_quarantined")).otherwise(F.size(names).cast("bigint")).alias("findings"),
        names.alias("features"),
    )


def report_names(reports: DataFrame, n: int = 10) -> DataFrame:
    return reports.select(F.concat_ws("_", "kind", F.lit("report"), "stamp").alias("name")).orderBy(F.desc("name")).limit(n)


def capped(df: DataFrame, order: Sequence, max_rows: int = S.MAX_ROWS) -> DataFrame:
    """At most ``max_rows`` rows plus ``truncated``: whether there were more. The limit is part of the plan."""
    more = df.limit(max_rows + 1).agg(F.count("*") > max_rows).scalar()
    return df.orderBy(*order).limit(max_rows).withColumn("truncated", more)


def assert_read_only(spark: SparkSession, sql: str) -> None:
    verdict = spark.range(1).select(classify_sql(F.lit(sql)).alias("v")).first()["v"]
    if not verdict["allowed"]:
        raise StatementRefused(f"Query rejected for safety: {verdict['reason']}")


def query_data(spark: SparkSession, root: str, sql: str, args: Mapping | None = None,
               max_rows: int = S.MAX_ROWS) -> tuple[DataFrame, bool]:
    """Run one read-only statement over the Gold views: (rows, were there more).

    It runs in a session of its own, and only after its parsed and its analysed plan were walked
    (``guard``): every leaf must be one of the four views' own files, every operator and expression on
    a list.  The statement runs once; at most ``max_rows`` + 1 rows come to the driver.
    """
    assert_read_only(spark, sql)
    session = spark.newSession()
    known, files = set(), set()
    for name in S.GOLD_DATASETS:
        if versions.holds_table(spark, dataset_path(root, name)):
            view = read_dataset(session, root, name)
            view.createOrReplaceTempView(name)
            known.add(name.lower())
            files |= guard.locations(view)
    session.conf.set("spark.sql.runSQLOnFiles", "false")
    guard.check_parsed(session, sql, known)
    result = session.sql(sql, dict(args) if args else None)
    guard.check_resolved(session, result, files)
    rows = result.limit(max_rows + 1).toArrow()
    return session.createDataFrame(rows.slice(0, max_rows), result.schema), rows.num_rows > max_rows


def run_summary(market: DataFrame, trades: DataFrame, scored: DataFrame) -> DataFrame:
    """Accepted, quarantined, scored and flagged counts of one run as (measure, value)."""
    def measures(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
        return df.select(F.explode(F.array(*[
            F.struct(F.lit(label).alias("measure"), F.col(c).cast("double").alias("value")) for c, label in names.items()
        ])).alias("m")).select("m.*")

    return (
        measures(market, {"rows_clean": "market rows accepted", "rows_quarantined": "market rows quarantined"})
        .unionByName(measures(trades, {"rows_clean": "trades accepted", "rows_quarantined": "trades quarantined"}))
        .unionByName(measures(scored, {"scored": "trades scored", "flagged": "surveillance alerts", "alert_rate": "alert rate"}))
    )
