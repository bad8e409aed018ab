"""Joins of many rows with a table of one row per key, whatever share of the rows one key has."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with more than one row in so many is hot; there are at most so many of them.
HOT_SHARE = 4096


def hot_keys(counts: DataFrame, n: str = "n") -> DataFrame:
    """Those rows of a (key, ``n``) table that hold more than 1 / HOT_SHARE of all: at most HOT_SHARE rows."""
    total = counts.agg(F.sum(n).cast("long")).scalar()
    return counts.where(F.col(n) * HOT_SHARE > total)


def join_lookup(rows: DataFrame, lookup: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Inner join with ``lookup`` (one row per key); rows of the keys in ``hot`` are not moved.

    ``hot`` has one column, the key, and at most HOT_SHARE rows.  Null keys match each other.
    """
    few = F.broadcast(hot.select(F.col(key).alias("_hot")))
    own = [c for c in lookup.columns if c != key]
    held = F.broadcast(lookup.join(few, F.col(key).eqNullSafe(F.col("_hot")), "left_semi"))
    rare = rows.join(few, F.col(key).eqNullSafe(F.col("_hot")), "left_anti")

    def joined(a: DataFrame, b: DataFrame) -> DataFrame:
        return a.join(b.withColumnRenamed(key, "_key"), F.col(key).eqNullSafe(F.col("_key"))).select(*rows.columns, *own)

    return joined(rows, held).unionByName(joined(rare, lookup))
