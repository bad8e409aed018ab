"""Exact quantiles for groups of any size, all groups in one pass.

Values are counted per bucket (at most 64 a power of two, combined before the shuffle); running sums tell
which buckets hold a group's rank, and only their values go on.  Those are counted by distinct value,
range-partitioned by group and value and written once.  Sums per (group, bucket, partition) tell in which
partition the rank lies; only those partitions are read again, and each numbers its own values.  No task
holds a whole group, nothing is collected, and every size takes the same way with the same arithmetic.
The rows are read twice: callers write what is dear to compute.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltledger.session import stage


def quantile(df: DataFrame, value: str, by: Sequence[str] = (), p: float = 0.5, alias: str = "quantile",
             accuracy: int | None = None) -> DataFrame:
    """A quantile of ``value`` per group: exact, or from mergeable sketches.

    With ``accuracy`` a every task keeps a sketch per group, sketches merge in one aggregation, and the result is
    a value whose rank is at most n / a away from the wanted one; memory per group grows with a, not with n.
    Null, NaN and null keys are left out in both forms.
    """
    if accuracy is None:
        return exact_quantiles(df, value, by, p, alias)
    if accuracy < 1:
        raise ValueError("accuracy must be at least 1")
    keys = list(by)
    x = F.col(value).cast("double")
    data = df.select(*keys, x.alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x")).dropna(subset=keys or None)
    return data.groupBy(*keys).agg(F.percentile_approx("_x", p, accuracy).alias(alias))


# Buckets per power of two, and a bound on the powers of doubles (infinity included).
_STEPS, _POWERS = 64, 1100


def _bucket(x: Column) -> Column:
    """A whole number that never falls as ``x`` grows: sign, power of two, and 1/64 of it."""
    power = F.least(F.log2(F.abs(x)), F.lit(float(_POWERS)))
    return F.coalesce(F.signum(x) * F.floor((power + _POWERS) * _STEPS), F.lit(0.0)).cast("int")


def exact_quantiles(df: DataFrame, value: str, by: Sequence[str] = (), p: float = 0.5, alias: str = "quantile") -> DataFrame:
    """Linear-interpolated quantile of ``value`` per group; null, NaN and null keys are left out.

    Infinite values rank like any other.  Without ``by`` there is one row, null if there are no values.
    """
    keys = list(by)
    x = F.col(value).cast("double")
    data = df.select(*keys, x.alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    for k in keys:
        data = data.where(F.col(k).isNotNull())
    data = data.withColumn("_b", _bucket(F.col("_x")))

    # Buckets that hold the rank, with what lies below them.
    group = Window.partitionBy(*(keys or [F.lit(0)]))
    upto = F.sum("_n").over(group.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0))
    rank = (F.sum("_n").over(group) - 1) * F.lit(p)
    sizes = data.groupBy(*keys, "_b").agg(F.count("*").alias("_n")).select(
        *keys, "_b", (upto - F.col("_n")).alias("_below"), upto.alias("_to"), rank.alias("_rank"))
    wanted = sizes.where((F.col("_below") <= F.ceil("_rank")) & (F.col("_to") > F.floor("_rank"))).drop("_to")
    inside = data.join(stage(wanted, "quantile-buckets"), [*keys, "_b"])

    counted = inside.groupBy(*keys, "_b", "_x").agg(F.count("*").alias("_c"), F.max("_below").alias("_below"), F.max("_rank").alias("_rank"))
    placed = stage(counted.repartitionByRange(*keys, "_x").withColumn("_part", F.spark_partition_id()), "quantile-values")

    # One row per group, bucket and partition that holds some of it.
    held = placed.groupBy(*keys, "_b", "_part").agg(F.sum("_c").alias("_n"), F.max("_below").alias("_below"), F.max("_rank").alias("_rank"))
    earlier = Window.partitionBy(*keys, "_b").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("_before", F.col("_below") + F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    wanted = held.where((F.col("_before") <= F.ceil("_rank")) & (F.col("_before") + F.col("_n") > F.floor("_rank"))).select(*keys, "_b", "_part", "_before")

    upto = F.col("_before") + F.sum("_c").over(Window.partitionBy(*keys, "_b", "_part").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0))
    numbered = placed.join(wanted, [*keys, "_b", "_part"]).select(*keys, "_x", "_rank", upto.alias("_to"), (upto - F.col("_c")).alias("_from"))

    def at(k):
        return F.max(F.when((F.col("_from") <= k) & (k < F.col("_to")), F.col("_x")))

    found = numbered.groupBy(*keys).agg(
        at(F.floor("_rank")).alias("_low"), at(F.ceil("_rank")).alias("_high"), F.max("_rank").alias("_rank"))
    between = (F.ceil("_rank") - F.col("_rank")) * F.col("_low") + (F.col("_rank") - F.floor("_rank")) * F.col("_high")
    return found.select(*keys, F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(between).alias(alias))
