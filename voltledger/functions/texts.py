"""Number formats used in reasons and figures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def general_number(x: Column) -> Column:
    """Six significant digits without trailing zeros: 85, 0.5, 1.23457e+07."""
    sci = F.format_string("%.5e", x)
    exponent = F.substring_index(sci, "e", -1)
    mantissa = F.regexp_replace(F.substring_index(sci, "e", 1), r"\.?0+$", "")
    plain = F.regexp_replace(sci.try_cast("decimal(38,12)").cast("string"), r"\.?0+$", "")
    return (
        F.when(x == 0, F.lit("0"))
        .when(exponent.try_cast("int").between(-4, 5), plain)
        .otherwise(F.concat(mantissa, F.lit("e"), exponent))
    )


def one_decimal(x: Column) -> Column:
    rounded = F.bround(x, 1)
    # Decimals are written many times faster than format strings are read; they hold any number below 1e16.
    return F.when(F.abs(rounded) < 1e16, rounded.try_cast("decimal(18,1)").cast("string")).otherwise(F.format_string("%.1f", rounded))


def rounded(x: Column, digits: int) -> Column:
    """``round(x, digits)``, half up, without decimal arithmetic for nearly all numbers.

    A whole number over a power of ten is the double nearest to that decimal. What lies within 1/1000 of a half,
    and what is too large for the product to be nearer than that, takes the long way. Up to nine digits.
    """
    scaled = x * 10.0**digits
    whole = F.rint(scaled)
    safe = (F.abs(scaled) < 2.0**40) & (F.abs(scaled - whole) < 0.499)
    # A zero has no sign in decimals.
    return F.when(safe, whole / 10.0**digits + 0.0).otherwise(F.round(x, digits))


def compact_eur(amount: Column) -> Column:
    """1234567 -> €1.23M."""
    size = F.abs(amount)
    c = F.when(amount.isNull() | F.isnan(amount), F.lit("n/a"))
    for limit, suffix in ((1e9, "B"), (1e6, "M"), (1e3, "k")):
        c = c.when(size >= limit, F.concat(F.lit("€"), F.format_number(amount / limit, 2), F.lit(suffix)))
    return c.otherwise(F.concat(F.lit("€"), F.format_number(amount, 0)))
