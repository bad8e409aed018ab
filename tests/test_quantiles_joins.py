"""Exact quantiles and lookups against brute force."""

import numpy as np
import pytest

from pyspark.sql import functions as F

from voltledger.operators import joins, quantiles
from voltledger.operators.quantiles import exact_quantiles
from voltledger.session import stage

RNG = np.random.default_rng(5)
SHAPES = {
    "uniform": RNG.uniform(-500, 4000, 4001),
    "two_decimals": np.round(RNG.normal(80, 15, 5000), 2),
    "one_hot_value": np.concatenate([np.full(3000, 42.5), RNG.normal(0, 100, 2999)]),
    "far_outlier": np.concatenate([RNG.normal(0, 1, 3000), [1e300, -1e300, 1e12]]),
    "constant": np.full(2000, 7.0),
    "two_values": np.array([1.0] * 1000 + [2.0] * 1000),
    "tiny_steps": 1e9 + np.arange(3000) * 1e-6,
}


SHAPES["infinite_ends"] = np.concatenate([RNG.normal(0, 1, 2000), [np.inf] * 40, [-np.inf] * 90])


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("p", [0.5, 0.02, 1.0])
def test_quantile_of_one_group(spark, shape, p):
    values = SHAPES[shape]
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(5)
    got = exact_quantiles(df, "v", p=p, alias="q").first()["q"]
    ordered, rank = np.sort(values), (len(values) - 1) * p
    low, high = ordered[int(np.floor(rank))], ordered[int(np.ceil(rank))]
    assert got == (low if low == high else pytest.approx(low + (high - low) * (rank - np.floor(rank)), rel=1e-12, abs=1e-12))


def test_groups_of_every_size(spark):
    groups = {"a": SHAPES["uniform"], "b": SHAPES["one_hot_value"], "c": np.array([3.0, 1.0, 2.0, 10.0]), "d": np.array([np.inf]),
              "e": SHAPES["infinite_ends"]}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("a", None), ("b", float("nan")), (None, 5.0), ("f", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.q for r in exact_quantiles(df, "v", ["g"], alias="q").collect()}
    assert got == pytest.approx({g: float(np.median(vs)) for g, vs in groups.items()})


def test_ten_thousand_groups_take_as_many_jobs_as_one(spark):
    def jobs(df, by):
        tracker, name = spark.sparkContext.statusTracker(), f"quantiles-{len(by)}-{id(df)}"
        spark.sparkContext.setJobGroup(name, name)
        try:
            rows = {tuple(r[k] for k in by): r.q for r in exact_quantiles(df, "v", by, alias="q").collect()}
            return len(tracker.getJobIdsForGroup(name)), rows
        finally:
            spark.sparkContext._jsc.clearJobGroup()

    df = spark.range(50_000).selectExpr("id % 10000 AS g", "cast((id * 7919) % 1000 AS double) AS v")
    many, found = jobs(df, ["g"])
    one, _ = jobs(df, [])
    values = {}
    for i in range(50_000):
        values.setdefault(i % 10000, []).append(float((i * 7919) % 1000))
    assert found == {(g,): float(np.median(vs)) for g, vs in values.items()}
    assert many <= one + 2


def test_no_values(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert exact_quantiles(df, "v", alias="q").first()["q"] is None


def test_lookup_with_hot_null_and_absent_keys(spark):
    keys = ["hot"] * 400 + [f"k{i % 37}" for i in range(200)] + [None] * 5 + ["absent"]
    left = spark.createDataFrame(list(enumerate(keys)), "id int, k string")
    right = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i + 2) for i in range(37)], "k string, v int")
    values = {"hot": 1} | {f"k{i}": i + 2 for i in range(37)}
    got = {r.id: r.v for r in joins.lookup_join(left, right, "k").collect()}
    assert got == {i: values.get(k) for i, k in enumerate(keys)}


@pytest.mark.parametrize("accuracy", [20, 200, 5000])
def test_sketched_quantiles_stay_within_their_rank_error(spark, accuracy):
    n = 20_000
    df = spark.range(n).select((F.col("id") % 3).alias("g"), F.pow(F.pmod(F.xxhash64("id"), F.lit(100_003)).cast("double"), 1.5).alias("x"))
    df = df.unionByName(spark.createDataFrame([(0, None), (1, float("nan")), (None, 5.0)], "g long, x double"))
    rows = [(r.g, r.x) for r in df.collect()]
    for p in (0.02, 0.5, 0.9):
        got = {r.g: r.q for r in quantiles.quantile(df, "x", ["g"], p, "q", accuracy).collect()}
        assert set(got) == {0, 1, 2}
        for g, q in got.items():
            held = sorted(x for k, x in rows if k == g and x is not None and x == x)
            assert abs(sum(x <= q for x in held) - p * len(held)) <= len(held) / accuracy + 1
    whole = quantiles.quantile(df, "x", accuracy=accuracy).first().quantile
    exact = quantiles.quantile(df, "x").first().quantile
    assert exact == quantiles.exact_quantiles(df, "x").first().quantile
    assert abs(df.where(F.col("x") <= whole).count() - n / 2) <= n / accuracy + 2
    with pytest.raises(ValueError):
        quantiles.quantile(df, "x", accuracy=0)


def test_outliers_and_features_take_the_sketch(spark):
    from voltledger.operators import features, gates

    df = spark.range(5000).select((F.col("id") % 100).cast("double").alias("v")).unionByName(spark.createDataFrame([(9000.0,)], "v double"))
    exact, rough = (gates.robust_outliers(df, "v", accuracy=a).first() for a in (None, 1000))
    assert (rough.n, rough.outliers, rough.worst) == (exact.n, exact.outliers, exact.worst) == (5001, 1, 9000.0)
    assert abs(rough.median - exact.median) <= 1 and abs(rough.mad_scale - exact.mad_scale) <= 2
    trades = spark.createDataFrame([("POWER", float(i)) for i in range(1, 200)] + [("NATURAL_GAS", 7.0)], "commodity string, price_eur_mwh double")
    got = {r.commodity: r.reference_price for r in features.reference_price(trades, accuracy=100).collect()}
    assert abs(got["POWER"] - 100) <= 3 and got["NATURAL_GAS"] == 7.0


def test_only_the_values_around_the_rank_are_written(spark, monkeypatch):
    written = {}
    monkeypatch.setattr(quantiles, "stage", lambda df, label: written.setdefault(label, stage(df, label)))
    df = spark.range(100_000).selectExpr("id % 2 AS g", "cast(id AS double) - 20000 AS v")
    got = {r.g: r.q for r in exact_quantiles(df, "v", ["g"], alias="q").collect()}
    assert got == {0: 29_999.0, 1: 30_000.0}
    assert written["quantile-values"].count() < 3_000


def test_buckets_never_fall_as_values_grow(spark):
    powers = [2.0**k for k in range(-1074, 1024, 7)] + [1.0, 2.0**0.5, 3.0, 1.7976931348623157e308, np.inf]
    near = sorted({float(y) for x in powers for y in (np.nextafter(x, 0.0), x, np.nextafter(x, np.inf))})
    values = [-v for v in reversed(near) if v] + near
    df = spark.createDataFrame(list(enumerate(values)), "i int, x double").select("i", quantiles._bucket(F.col("x")).alias("b"))
    buckets = [r.b for r in df.orderBy("i").collect()]
    assert None not in buckets and buckets == sorted(buckets)
    # Zero has its own.
    assert sum(b == 0 for b in buckets) == 1
