"""Equi-joins of a large table with a one-row-per-key table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


# A table of more keys is hashed part by part: the rows of ``left``, many times as many, need no sort.
HASHED_KEYS = 1_000_000


def lookup_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], written: bool = False) -> DataFrame:
    """Left outer join with ``right``, which holds at most one row per key.

    Adaptive execution broadcasts ``right`` once its measured size allows, and otherwise splits the left
    partition of a hot (or null) key over several tasks.  If ``right`` is ``written``, so that its rows are
    cheap to count, a large one is hashed per partition.
    """
    if written and right.limit(HASHED_KEYS + 1).count() > HASHED_KEYS:
        right = right.hint("shuffle_hash")
    return left.join(right, [on] if isinstance(on, str) else list(on), "left")
