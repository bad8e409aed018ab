"""Named queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


CATALOG: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Run], Run]:
    """Register the decorated function under its own name."""

    def register(run: Run) -> Run:
        if run.__name__ in CATALOG:
            raise ValueError(f"query {run.__name__} is registered twice")
        CATALOG[run.__name__] = Query(run, sql)
        return run

    return register
