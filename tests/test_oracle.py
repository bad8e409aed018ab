"""Every catalog query against its SQL over the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, duck, name):
    problem = compare(QUERIES[name](spark, sf_dir).toPandas(), duck.execute(SQL[name]).df())
    assert problem is None, problem


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_flagship_anchor(spark):
    rows = {r.commodity: (r.total_trades, r.portfolio_notional_eur, r.total_portfolio_pnl_eur) for r in entry.entry(spark).collect()}
    assert rows == {"NATURAL_GAS": (2320, 3061778.50, 20360.70), "POWER": (2279, 3015998.13, 65429.82)}
