"""Data-quality gates: validate rows, route them, judge the batch, report.

Rows that break the contract go to quarantine and the batch carries on, unless more
than 20 % of it failed or nothing clean is left.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voltledger import settings as S
from voltledger.functions.contracts import MARKET_PRICES, TRADES, Contract, coerced, failures
from voltledger.operators.joins import lookup_join
from voltledger.operators.quantiles import quantile
from voltledger.session import stage

EXAMPLES = 3


@dataclass
class GateResult:
    """Lazy tables of one gate run; ``verdict`` has a single row."""

    name: str
    routed: DataFrame
    clean: DataFrame
    quarantined: DataFrame
    findings: DataFrame
    verdict: DataFrame
    stats: DataFrame

    def judge(self) -> Row:
        return self.verdict.first()

    def summary(self) -> str:
        v, n = self.judge(), self.findings.count()
        return (
            f"[{'PASS' if v.passed else 'FAIL'}] gate={self.name} clean={v.rows_clean} "
            f"quarantined={v.rows_quarantined} findings={n}"
        )


def route(df: DataFrame, contract: Contract) -> DataFrame:
    """``df`` plus ``failures``: an array of (check, column, value), empty for a clean row."""
    flags = {}
    for name in contract.unique_columns:
        if name not in df.columns:
            continue
        # Every member of a duplicate group fails. Counting keys first moves one row per
        # key and task, so a key repeated millions of times does not overload one task.
        flag = f"_dup_{name}"
        repeated = (
            df.where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("_n"))
            .where("_n > 1").select(name, F.lit(True).alias(flag))
        )
        df = lookup_join(df, repeated, name)
        flags[name] = flag
    return df.withColumn("failures", failures(df, contract, flags)).drop(*flags.values())


def clean_rows(routed: DataFrame, contract: Contract) -> DataFrame:
    """Rows that passed every check, in the contract's types."""
    typed = {f.name: coerced(routed, f) for f in contract.fields if f.name in routed.columns}
    return routed.where(F.size("failures") == 0).drop("failures").withColumns(typed)


def quarantined_rows(routed: DataFrame) -> DataFrame:
    """Rejected rows as they came, with the names of the checks they failed."""
    return (
        routed.where(F.size("failures") > 0)
        .withColumn("failed_checks", F.transform("failures", lambda f: f["check"]))
        .drop("failures")
    )


def batch_verdict(routed: DataFrame, gate: str, max_ratio: float = S.MAX_FAILURE_RATIO) -> DataFrame:
    """One row: counts, failure ratio, passed. An empty batch passes."""
    counts = routed.agg(
        F.count("*").alias("rows_total"),
        F.count_if(F.size("failures") > 0).alias("rows_quarantined"),
    ).withColumn("rows_clean", F.col("rows_total") - F.col("rows_quarantined"))
    ratio = F.col("rows_quarantined") / F.greatest(F.col("rows_total"), F.lit(1))
    return counts.select(
        F.lit(gate).alias("gate"), "rows_total", "rows_clean", "rows_quarantined",
        F.round(ratio, 4).alias("failure_ratio"),
        ((F.col("rows_total") == 0) | ((ratio <= max_ratio) & (F.col("rows_clean") > 0))).alias("passed"),
    )


def check_findings(routed: DataFrame, order: Sequence[str]) -> DataFrame:
    """Per distinct check the number of failures and the first three failing values."""
    broken = routed.select(*order, F.explode("failures").alias("f")).select(*order, "f.*")
    counts = broken.groupBy("check").agg(F.count("*").alias("failures"))
    first = W.partitionBy("check").orderBy(*order, "column", "value")
    # The rank limit is applied before the shuffle as well, so each task sends three rows per check.
    examples = (
        broken.withColumn("rn", F.row_number().over(first)).where(F.col("rn") <= EXAMPLES)
        .groupBy("check")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("rn", F.coalesce("value", F.lit("None")).alias("v")))),
                         lambda e: e["v"]).alias("examples"))
    )
    return counts.join(examples, "check")


def robust_outliers(
    df: DataFrame,
    column: str,
    by: Sequence[str] = (),
    z: float = S.OUTLIER_Z,
    min_rows: int = S.OUTLIER_MIN_ROWS,
    accuracy: int | None = None,
) -> DataFrame:
    """Median/MAD outliers per group (one group without ``by``).

    Medians are exact; with ``accuracy`` they come from mergeable sketches (``quantiles.quantile``).

    Groups with fewer than ``min_rows`` rows are left out.  Where the MAD is zero the
    standard deviation stands in; a scale of zero gives zero outliers and no scale.
    """
    keys = list(by) or ["_all"]
    value = F.col(column).try_cast("double")
    if not by:
        df = df.withColumn("_all", F.lit(0))
    usable = value.isNotNull() & ~F.isnan(value)
    rows = df.select(*keys, F.when(usable, value).alias("x"))
    counted = rows.groupBy(*keys).agg(
        F.count("x").alias("_n"), F.coalesce(F.stddev_samp("x"), F.lit(0.0)).alias("_std"))
    median = stage(quantile(rows, "x", keys, alias="median", accuracy=accuracy), "medians")
    rows = lookup_join(rows, median, keys).withColumn("dev", F.abs(F.col("x") - F.col("median")))
    spread = quantile(rows, "dev", keys, alias="_mad", accuracy=accuracy)
    spread = spread.join(counted, keys).select(
        *keys, F.when(F.col("_mad") > 0, F.col("_mad") * S.MAD_TO_SIGMA).otherwise(F.col("_std")).alias("scale"))
    rows = lookup_join(rows, stage(spread, "spreads"), keys)
    far = (F.col("scale") > 0) & (F.col("dev") / F.nullif("scale", F.lit(0.0)) > z)
    highest, lowest, median_ = F.max("x"), F.min("x"), F.max("median")
    out = (
        rows.groupBy(*keys)
        .agg(
            F.count("*").alias("n"),
            F.count("x").alias("_used"),
            median_.alias("median"),
            F.max("scale").alias("_scale"),
            F.count_if(far).alias("outliers"),
            # The value farthest from the median is one of the two ends.
            F.when(highest - median_ >= median_ - lowest, highest).otherwise(lowest).alias("_worst"),
        )
        .where((F.col("n") >= min_rows) & (F.col("_used") > 0))
    )
    return out.select(
        *by, "n", "median",
        F.when(F.col("_scale") > 0, F.round("_scale", 4)).alias("mad_scale"),
        "outliers",
        F.when(F.col("outliers") > 0, F.col("_worst")).alias("worst"),
    )


def plausibility(df: DataFrame, column: str = "price_eur_mwh",
                 low: float = S.PRICE_PLAUSIBLE_MIN, high: float = S.PRICE_PLAUSIBLE_MAX) -> DataFrame:
    """Number of legal but unusual values (flagged, never removed)."""
    value = F.col(column).try_cast("double")
    outside = ~F.isnan(value) & ~value.between(low, high)
    return df.agg(F.count("*").alias("rows_checked"), F.count_if(outside).alias("implausible"))


def replayed_ids(df: DataFrame, key: str = "trade_id") -> DataFrame:
    """How many rows repeat an id seen before."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_checked"), F.count("*").alias("distinct_ids"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
    )


def _outlier_finding(stats: DataFrame, column: str) -> DataFrame:
    return stats.where("outliers > 0").select(
        F.lit("outlier").alias("kind"), F.lit(f"robust_z({column})").alias("check"),
        F.col("outliers").alias("failures"), F.array(F.col("worst").cast("string")).alias("examples"),
        F.format_string(
            S.FINDING_OUTLIERS, "outliers", F.lit(column), F.lit(str(S.OUTLIER_Z)), "worst", "median",
        ).alias("message"),
    )


def validate(
    df: DataFrame,
    contract: Contract,
    order: Sequence[str],
    outlier_columns: Sequence[str] = (),
    plausible_column: str | None = None,
    replay_key: str | None = None,
    max_ratio: float = S.MAX_FAILURE_RATIO,
) -> GateResult:
    """Run one gate. ``order`` makes the example values of the findings reproducible."""
    # Routed once, read by clean, quarantine, verdict, findings and statistics.
    routed = stage(route(df, contract), f"gate-{contract.name}")
    clean = clean_rows(routed, contract)
    verdict = batch_verdict(routed, contract.name, max_ratio)
    findings = check_findings(routed, order).select(
        F.lit("check").alias("kind"), "check", "failures", "examples",
        F.format_string(
            S.FINDING_CHECK, "check", "failures", F.array_join("examples", ", "),
        ).alias("message"),
    )
    findings = findings.unionByName(
        verdict.where("not passed").select(
            F.lit("verdict").alias("kind"), F.lit("failure_ratio").alias("check"),
            F.col("rows_quarantined").alias("failures"), F.array().cast("array<string>").alias("examples"),
            F.format_string(
                S.FINDING_RATIO, F.col("failure_ratio") * 100, F.lit(max_ratio * 100.0),
            ).alias("message"),
        )
    )
    all_stats = None
    for column in outlier_columns:
        if column not in df.columns:
            continue
        stats = robust_outliers(clean, column)
        findings = findings.unionByName(_outlier_finding(stats, column))
        stats = stats.select(F.lit(column).alias("column"), "n", "median", "mad_scale", "outliers")
        all_stats = stats if all_stats is None else all_stats.unionByName(stats)
    if plausible_column is not None and plausible_column in df.columns:
        findings = findings.unionByName(
            plausibility(clean, plausible_column).where("implausible > 0").select(
                F.lit("plausibility").alias("kind"), F.lit(f"plausible({plausible_column})").alias("check"),
                F.col("implausible").alias("failures"), F.array().cast("array<string>").alias("examples"),
                F.format_string(
                    S.FINDING_BAND, "implausible", F.lit(str(S.PRICE_PLAUSIBLE_MIN)), F.lit(str(S.PRICE_PLAUSIBLE_MAX)),
                ).alias("message"),
            )
        )
    if replay_key is not None and replay_key in df.columns and replay_key not in contract.unique_columns:
        # With the key declared unique, no clean row can repeat it.
        findings = findings.unionByName(
            replayed_ids(clean, replay_key).where("duplicates > 0").select(
                F.lit("replay").alias("kind"), F.lit(f"replay({replay_key})").alias("check"),
                F.col("duplicates").alias("failures"), F.array().cast("array<string>").alias("examples"),
                F.format_string(S.FINDING_REPLAY, "duplicates", F.lit(replay_key)).alias("message"),
            )
        )
    if all_stats is None:
        all_stats = df.sparkSession.createDataFrame(
            [], "column string, n bigint, median double, mad_scale double, outliers bigint")
    return GateResult(
        contract.name, routed, clean, quarantined_rows(routed),
        findings.select(F.lit(contract.name).alias("gate"), "*"), verdict, all_stats,
    )


def validate_market_prices(df: DataFrame, contract: Contract | None = None) -> GateResult:
    order = [c for c in ("timestamp_ms", "price_eur_mwh") if c in df.columns]
    return validate(df, contract or MARKET_PRICES, order, ("price_eur_mwh",), "price_eur_mwh")


def validate_trades(df: DataFrame, contract: Contract | None = None) -> GateResult:
    order = [c for c in ("trade_id",) if c in df.columns]
    return validate(df, contract or TRADES, order, ("volume_mw", "price_eur_mwh"), None, "trade_id")


def overall_verdict(verdicts: DataFrame) -> DataFrame:
    return verdicts.agg(F.coalesce(F.every("passed"), F.lit(True)).alias("overall_passed"))
