"""Run catalog queries next to their SQL and compare the rows as multisets.

    python tests/oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def rows(df: pd.DataFrame) -> Counter:
    def plain(v):
        if v is None or (isinstance(v, float) and v != v) or v is pd.NaT or v is pd.NA:
            return None
        if isinstance(v, bool):
            return v
        if hasattr(v, "item"):
            v = v.item()
        return float(v) if isinstance(v, int) and not isinstance(v, bool) else v

    names = sorted(df.columns)
    return Counter(tuple(plain(v) for v in r) for r in df[names].itertuples(index=False, name=None))


def compare(spark_df: pd.DataFrame, sql_df: pd.DataFrame) -> str | None:
    """None if equal, else what differs."""
    if sorted(spark_df.columns) != sorted(sql_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(sql_df.columns)}"
    a, b = rows(spark_df), rows(sql_df)
    if a == b:
        return None
    return f"{len(spark_df)} vs {len(sql_df)} rows; only ours {list((a - b).items())[:3]}; only SQL {list((b - a).items())[:3]}"


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con, sql = connect(sf_dir), entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            ours = run(spark, sf_dir).toPandas()
            took = time.time() - start
            problem = compare(ours, con.execute(sql[name]).df()) if name in sql else None
            kinds = ""
            if name in sql and problem is None:
                theirs = con.execute(sql[name]).df()
                kinds = " ".join(f"{c}:{ours[c].dtype}/{theirs[c].dtype}" for c in ours.columns if str(ours[c].dtype) != str(theirs[c].dtype))
        except Exception as error:  # noqa: BLE001 - report and go on
            took, problem, kinds, ours = time.time() - start, f"{type(error).__name__}: {str(error)[:600]}", "", []
        bad += problem is not None
        print(f"{'OK ' if problem is None else 'BAD'} {name:28s} {took:6.2f}s rows={len(ours)} {'sql' if name in sql else 'rows-only'} {kinds} {problem or ''}", flush=True)
    print(f"{bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
