"""Gate behaviour: routing, verdicts, findings, outliers."""

import math

import numpy as np
import pandas as pd
import pytest

from voltledger.functions.contracts import MARKET_PRICES, TRADES
from voltledger.operators import gates

DAY_MS = 1_704_067_200_000


def prices(spark, values, at=None):
    """Half-hourly prices, newest first."""
    times = at or [DAY_MS + 1_800_000 * (len(values) - i) for i in range(len(values))]
    return spark.createDataFrame(list(zip(times, values, strict=True)), "timestamp_ms long, price_eur_mwh double")


def quiet(n):
    """n plausible prices around 61."""
    return [round(61 + 9 * math.sin(i), 2) for i in range(n)]


GOOD = {"trade_id": "TRD-70{:03d}", "trader_id": "desk{}", "counterparty": "Nordwind {}", "commodity": "NATURAL_GAS",
        "buy_sell": "SELL", "volume_mw": 12.5, "price_eur_mwh": 40.0}


def trades(spark, n=20, every=1, **changed):
    """n good trades; every so many-th gets the changed fields."""
    rows = []
    for i in range(n):
        row = {k: v.format(i) if isinstance(v, str) else v + i for k, v in GOOD.items()}
        rows.append(tuple((row | (changed if i % every == 0 else {})).values()))
    kinds = ("string",) * 5 + ("double",) * 2
    return spark.createDataFrame(rows, ", ".join(f"{k} {t}" for k, t in zip(GOOD, kinds, strict=True)))


def verdict(result):
    v = result.judge()
    return v.passed, v.rows_clean, v.rows_quarantined


def messages(result):
    return [r.message for r in result.findings.collect()]


@pytest.mark.parametrize("n", [1, 9, 64])
def test_plausible_prices_pass(spark, n):
    result = gates.validate_market_prices(prices(spark, quiet(n)))
    assert verdict(result) == (True, n, 0)
    assert result.summary() == f"[PASS] gate=market_prices clean={n} quarantined=0 findings=0"


@pytest.mark.parametrize("factor, passed", [(-1, True), (1, True), (60, False), (-60, False)])
def test_scale_and_sign(spark, factor, passed):
    """Prices in another unit leave the limits as a whole; negative prices within them are legal."""
    values = [factor * (v + 20) for v in quiet(24)]
    assert verdict(gates.validate_market_prices(prices(spark, values))) == (passed, 24 * passed, 24 * (not passed))


@pytest.mark.parametrize("spike", [1234.5, -321.0])
def test_a_legal_spike_is_a_finding(spark, spike):
    values = quiet(40)
    values[7] = spike
    result = gates.validate_market_prices(prices(spark, values))
    assert result.judge().passed
    assert any("outlier" in m and f"{spike:,.2f}" in m for m in messages(result))
    assert any("plausible band" in m for m in messages(result))


@pytest.mark.parametrize("n, bad", [(25, 5), (25, 6), (10, 2), (10, 3), (7, 1), (7, 2)])
def test_share_of_bad_rows_decides(spark, n, bad):
    values = quiet(n)
    values[:bad] = [None if i % 2 else 4321.0 for i in range(bad)]
    result = gates.validate_market_prices(prices(spark, values))
    passed = bad / n <= 0.2
    assert verdict(result) == (passed, n - bad, bad)
    assert result.quarantined.count() == bad and result.clean.count() == n - bad
    assert any("batch rejected" in m for m in messages(result)) is (not passed)


def test_findings_count_failures_with_three_examples(spark):
    values = [5000.0 + i for i in range(4)] + quiet(36)
    result = gates.validate_market_prices(prices(spark, values, at=[DAY_MS + i for i in range(40)]))
    (row,) = result.findings.where("kind = 'check'").collect()
    assert row.check == "less_than_or_equal_to(4000.0)" and row.failures == 4
    assert row.examples == ["5000.0", "5001.0", "5002.0"]


@pytest.mark.parametrize("value, ok", [
    (-500.0, True), (4000.0, True), (4000.01, False), (-500.01, False), (float("nan"), False), (None, False),
])
def test_price_limits(spark, value, ok):
    routed = gates.route(prices(spark, [value]), MARKET_PRICES).first()
    assert (not routed.failures) is ok
    if value is None or math.isnan(value):
        assert [f.check for f in routed.failures] == ["not_nullable"]


@pytest.mark.parametrize("ms, ok", [(946_684_800_000, False), (946_684_800_001, True), (4_102_444_800_000, False)])
def test_timestamp_limits_are_exclusive(spark, ms, ok):
    df = spark.createDataFrame([(ms, 1.0)], "timestamp_ms long, price_eur_mwh double")
    assert (not gates.route(df, MARKET_PRICES).first().failures) is ok


def test_uncastable_value_fails_once(spark):
    df = spark.createDataFrame([(str(DAY_MS), "-3.25"), ("noon", "7"), (str(DAY_MS + 1), "7,5")], "timestamp_ms string, price_eur_mwh string")
    routed = {r.price_eur_mwh: [f.check for f in r.failures] for r in gates.route(df, MARKET_PRICES).collect()}
    assert routed == {"-3.25": [], "7": ["coerce_dtype('bigint')"], "7,5": ["coerce_dtype('double')"]}
    clean = gates.clean_rows(gates.route(df, MARKET_PRICES), MARKET_PRICES)
    assert dict(clean.dtypes)["price_eur_mwh"] == "double" and clean.first().price_eur_mwh == -3.25


def test_good_trades_pass(spark):
    assert verdict(gates.validate_trades(trades(spark))) == (True, 20, 0)


@pytest.mark.parametrize("field, values", [
    ("commodity", ["COAL", "power", ""]), ("buy_sell", ["Sell", None]), ("volume_mw", [0.0, -0.01, 10_000.5]),
    ("price_eur_mwh", [-500.5, 4000.5, None]), ("counterparty", ["N", "N" * 51, None]), ("trader_id", [None]),
    ("trade_id", ["TRD-7", "xTRD-70000", "TRD-70000\r", "TRD-70000\u2028", "TRD-700000", None]),
])
def test_a_broken_field_is_quarantined_alone(spark, field, values):
    for value in values:
        result = gates.validate_trades(trades(spark, every=20, **{field: value}))
        assert verdict(result) == (True, 19, 1), value
        assert len(result.quarantined.first().failed_checks) == 1


@pytest.mark.parametrize("copies", [1, 3])
def test_every_member_of_a_duplicate_group_fails(spark, copies):
    df = trades(spark, 40)
    for _ in range(copies):
        df = df.union(trades(spark, 2))
    result = gates.validate_trades(df)
    assert verdict(result) == (True, 38, 2 + 2 * copies)
    assert {r.trade_id for r in result.quarantined.collect()} == {"TRD-70000", "TRD-70001"}


@pytest.mark.parametrize("column", ["price_eur_mwh", "trade_id"])
def test_missing_column_quarantines_the_whole_batch(spark, column):
    assert verdict(gates.validate_trades(trades(spark, commodity="COAL", every=3).drop(column))) == (False, 0, 20)


def test_empty_batch_passes(spark):
    assert verdict(gates.validate_trades(trades(spark).limit(0))) == (True, 0, 0)


def test_clean_and_quarantined_make_up_the_input(spark):
    df = prices(spark, [-7000.0, None, float("nan"), 88.0] * 3 + quiet(11))
    routed = gates.route(df, MARKET_PRICES)
    parts = gates.clean_rows(routed, MARKET_PRICES).unionByName(gates.quarantined_rows(routed).drop("failed_checks"))
    assert parts.exceptAll(df).isEmpty() and df.exceptAll(parts).isEmpty()


def brute_outliers(values):
    s = pd.Series(values, dtype=float).dropna()
    median = s.median()
    mad = (s - median).abs().median()
    scale = mad * 1.4826 if mad > 0 else s.std()
    if not scale > 0:
        return median, 0
    return median, int(((s - median).abs() / scale > 5).sum())


@pytest.mark.parametrize("values", [
    list(np.random.default_rng(1).normal(80, 5, 200)) + [900.0, -300.0],
    [50.0] * 40 + [51.0, 400.0],            # MAD 0: the standard deviation takes over
    [7.0] * 20,                             # no spread at all
    [1.0, None, float("nan")] * 10 + [100.0],
])
def test_outliers_match_brute_force(spark, values):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double")
    row = gates.robust_outliers(df, "v").first()
    median, count = brute_outliers(values)
    assert row.median == pytest.approx(median) and row.outliers == count


@pytest.mark.parametrize("n, rows", [(9, 0), (10, 1)])
def test_outliers_need_ten_rows(spark, n, rows):
    df = spark.createDataFrame([(float(i),) for i in range(n)], "v double")
    assert gates.robust_outliers(df, "v").count() == rows


def test_replay_is_found_when_the_key_is_not_declared_unique(spark):
    relaxed = TRADES.with_field("trade_id", unique=False)
    df = trades(spark).union(trades(spark, 3))
    assert any("3 duplicate trade_id(s)" in m for m in messages(gates.validate_trades(df, relaxed)))
    row = gates.replayed_ids(df).first()
    assert (row.rows_checked, row.distinct_ids, row.duplicates) == (23, 20, 3)
