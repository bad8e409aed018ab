"""Distances from a training baseline, and risk bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voltledger import settings as S
from voltledger.functions.texts import general_number, one_decimal


def effective_std(mean: Column, std: Column) -> Column:
    """Floored so that a nearly constant feature cannot produce huge distances."""
    return F.greatest(
        F.coalesce(std, F.lit(0.0)),
        F.abs(F.coalesce(mean, F.lit(0.0))) * S.STD_FLOOR_FRACTION,
        F.lit(S.STD_FLOOR),
    )


def was_constant(std: Column) -> Column:
    return F.coalesce(std, F.lit(0.0)) <= S.STD_FLOOR


def sigma_shift(value: Column, mean: Column, std: Column) -> Column:
    distance = F.abs(value - F.coalesce(mean, F.lit(0.0))) / effective_std(mean, std)
    return F.least(distance, F.lit(S.SIGMA_CAP))


def constant_in_training(std: float | None) -> bool:
    """``was_constant`` for a number."""
    return (std or 0.0) <= S.STD_FLOOR


def never_seen(feature: Column, value: Column, mean: Column) -> Column:
    return F.concat(
        feature, F.lit(" = "), general_number(value), F.lit(", a value never seen in normal trading (constant "),
        general_number(mean), F.lit(" during training)"),
    )


def far_off(feature: Column, shift: Column) -> Column:
    return F.concat(feature, F.lit(" is "), one_decimal(shift), F.lit(" sigma from normal"))


def describe(feature: Column, value: Column, shift: Column, mean: Column, std: Column) -> Column:
    """One readable sentence on why a value stands out."""
    return F.when(was_constant(std), never_seen(feature, value, mean)).otherwise(far_off(feature, shift))


def risk_band(score: Column) -> Column:
    (first, label), *rest = S.RISK_BANDS
    c = F.when(score >= first, F.lit(label))
    for threshold, label in rest:
        c = c.when(score >= threshold, F.lit(label))
    return c.otherwise(F.lit(S.LOWEST_BAND))
