"""What lets a step grow with its input: code that the JVM compiles, and tasks that all work at once."""

import contextlib
import io
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voltledger import settings as S
from voltledger.functions import signatures
from voltledger.functions.contracts import MARKET_PRICES
from voltledger.functions.texts import one_decimal, rounded
from voltledger.operators import features, forest, gates, joins, sampling, scan, surveillance
from voltledger.plans import feature_queries, medallion, surrogate
from voltledger.plans import market_tables as M
from voltledger.session import stage

# The JVM never compiles a longer method; it interprets it for every row.
HUGE_METHOD = 8000


@pytest.fixture
def plain_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")


def largest_method(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("codegen")
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue()))


@pytest.mark.parametrize("name", ["trade_features", "top_reason", "risk_bands"])
def test_row_code_of_feature_queries_is_compiled(spark, sf_dir, plain_plans, name):
    assert largest_method(getattr(feature_queries, name)(spark, sf_dir)) < HUGE_METHOD


def test_row_code_of_the_forest_is_compiled(spark, sf_dir, plain_plans, monkeypatch):
    staged = []
    monkeypatch.setattr(surveillance, "stage", lambda df, label: staged.append(df) or stage(df, label))
    trades = stage(M.silver_trades(spark, sf_dir), "silver")
    model = surveillance.train(trades, trees=4)
    book = stage(M.valued_trades(spark, sf_dir, trades), "gold")
    staged.append(surveillance.score(book, model))
    assert max(map(largest_method, staged)) < HUGE_METHOD


def test_sentences_on_constant_and_varying_features(spark):
    names = ("volume_mw", "delivery_hours", "is_off_market")
    base = {"volume_mw": {"mean": 10.0, "std": 2.0}, "delivery_hours": {"mean": 4.0, "std": 0.0}, "is_off_market": None}
    rows = spark.createDataFrame([(1, 14.0, 4.0, 0.0), (2, 10.0, 4.25, 0.0), (3, 10.0, 4.0, 1.0), (4, None, 4.0, 0.0), (5, 1e9, 1e9, 0.0)],
                                 "id int, volume_mw double, delivery_hours double, is_off_market double")
    found = surveillance.with_top_reason(rows, {n: rows[n] for n in names}, base).orderBy("id")
    assert found.columns == ["id", *names, "top_reason"]
    assert [r.top_reason for r in found.collect()] == [
        "volume_mw is 2.0 sigma from normal",
        "delivery_hours = 4.25, a value never seen in normal trading (constant 4 during training)",
        surveillance.NO_REASON,
        f"volume_mw is {S.SIGMA_CAP:.1f} sigma from normal",
        # Both are at the cap: the first in feature order.
        f"volume_mw is {S.SIGMA_CAP:.1f} sigma from normal",
    ]


def test_all_partitions_are_searched_before_threats_are_named(spark):
    # A bare limit reads the first partition alone, then a few more at a time: the message named whatever came first.
    found = spark.range(0, 400, 1, 40).select((F.lit(399) - F.col("id")).alias("id"), F.lit("../x").alias("text"))
    with pytest.raises(scan.ContentThreat, match="'id': 0, "):
        scan.require_clean(scan.scan_text(found, "text", ["id"]), "Batch", shown=2)


def test_payloads_of_one_partition_are_walked_by_several_tasks(spark, tmp_path, monkeypatch):
    seen = []

    def look(df, *a):
        seen.append(df.select(F.spark_partition_id()).distinct().count())
        return scan.scan_documents(df, *a)

    monkeypatch.setattr(medallion, "scan_documents", look)
    # Incompressible names make the texts large enough (over 1 MB a task) to be dealt out.
    json = F.concat(F.lit('{"market":"M","commodity":"POWER","fetched_at":"'), *[F.sha2((F.col("id") * 64 + i).cast("string"), 256) for i in range(12)],
                    F.lit('","series":[{"timestamp_ms":'), (F.col("id") * 1000 + 1_704_067_200_000).cast("string"), F.lit(',"price_eur_mwh":40.5}]}'))
    payloads = spark.range(0, 20_000, 1, 1).select(F.col("id").cast("string").alias("file"), json.alias("json"))
    result = medallion.secure_ingest(payloads, str(tmp_path), "20240101_000000")
    assert result.gate.judge().rows_clean == 20_000
    assert seen[0] > 1


def test_one_look_rules_out_only_texts_without_signatures():
    for alternatives in signatures._REQUIRED:
        for parts in alternatives:
            assert any(telling in part for telling in signatures._TELLING for part in parts)


def test_entities_are_counted_once_for_two_market_prices(spark, sf_dir, monkeypatch):
    counted = []
    book_counts = features.book_counts
    monkeypatch.setattr(features, "book_counts", lambda df, columns: counted.append(columns) or book_counts(df, columns))
    feature_queries.top_reason(spark, sf_dir)
    assert len(counted) == 1


def test_scored_book_writes_only_what_it_returns(spark, sf_dir, monkeypatch):
    written = {}
    monkeypatch.setattr(surrogate, "stage", lambda df, label: written.setdefault(label, stage(df, label)))
    out = surrogate.surrogate_scored(spark, sf_dir)
    assert set(written["featured"].columns) - {"_features"} <= set(out.columns)


def test_row_code_of_gates_is_generated_and_compiled(spark, sf_dir, plain_plans):
    routed = gates.route(M.unit_prices(spark, sf_dir), MARKET_PRICES)
    assert "lambda" not in routed._jdf.queryExecution().executedPlan().toString()
    assert largest_method(routed) < HUGE_METHOD
    assert largest_method(gates.route(M.raw_trades(spark, sf_dir), M.MAPPED_TRADES)) < HUGE_METHOD


def test_one_decimal_is_the_format_of_the_rounded_number(spark):
    values = [0.0, -0.0, 0.05, 0.25, 0.35, -0.04, -2.25, 99.0, 1e15 + 0.25, 9.99e15, 1e16, 1e300, float("inf"), float("nan"), None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for r in df.select(one_decimal(F.col("x")).alias("got"), F.format_string("%.1f", F.bround("x", 1)).alias("want")).collect():
        assert r.got == r.want


def test_silver_joins_customers_to_orders_and_ranks_numbers(spark, sf_dir, plain_plans):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = M.silver_trades(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    # Shuffles by customer hold no line, and no text is a key of the survivor's sort.
    by_customer = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(o_custkey" in line]
    assert by_customer and "l_orderkey" not in lines[by_customer[0] + 1]
    assert all("trade_number" in line.split("Sort [")[1].split(" ASC")[0] for line in lines if "Sort [" in line and "created_at" in line)
    assert "hashpartitioning(trade_id" not in plan


def test_large_written_lookup_needs_no_sort_of_the_rows(spark, monkeypatch):
    monkeypatch.setattr(joins, "HASHED_KEYS", 10)
    left = spark.range(500).select("id", F.when(F.col("id") % 5 > 0, F.concat(F.lit("k"), F.col("id") % 30)).alias("k"))
    right = spark.range(25).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v"))
    want = {i: i % 30 if i % 5 and i % 30 < 25 else None for i in range(500)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for written, operator in ((True, "ShuffledHashJoin"), (False, "SortMergeJoin")):
            out = joins.lookup_join(left, stage(right), "k", written=written)
            assert operator in out._jdf.queryExecution().executedPlan().toString()
            assert {r.id: r.v for r in out.collect()} == want
        small = joins.lookup_join(left, stage(right.limit(10)), "k", written=True)
        assert "ShuffledHashJoin" not in small._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rounded_is_round(spark):
    odd = [0.0, -0.0, -1e-9, 4.9999999e-7, 5e-7, -5e-7, 1.0000005, 2.5000015, 1099511.6277755, 1e15 + 0.3, 1e300, float("inf"), float("-inf"), float("nan"), None]
    df = spark.createDataFrame([(v,) for v in odd], "x double").union(
        spark.range(20_000).select(((F.col("id") * 7919 - 10_000) + F.lit(0.5)) / 1e6)).union(
        spark.range(20_000).select((F.rand(1) - 0.5) * F.pow(F.lit(10.0), F.rand(2) * 16 - 8)))
    both = df.select("x", rounded(F.col("x"), 6).cast("string").alias("got"), F.round("x", 6).cast("string").alias("want"))
    assert both.where(~F.col("got").eqNullSafe(F.col("want"))).collect() == []
    # Both ways are taken.
    assert 0 < both.where((F.abs("x") < 1e5) & (F.abs(F.abs(F.col("x") * 1e6 - F.rint(F.col("x") * 1e6)) - 0.5) < 1e-3)).count() < 21_000


@pytest.mark.parametrize("copies", [1, 2])
def test_sketch_holds_the_rows_it_needs_only(copies):
    # Of rows that occur more than once, those after a clearing within a block were mixed up with others.
    salt, k = sampling.salts(50, 7), 16
    h = sampling.mix(np.arange(1, 6001, dtype=np.uint64))
    x = (h >> np.uint64(11)).astype(float)[:, None]
    sketch, held = sampling.Sketch(salt, k, 1), 0
    for start in range(0, len(h), 1500):
        part = slice(start, start + 1500)
        sketch.add(h[part], np.full(1500, copies), x[part])
        held = max(held, len(sketch.h) + sum(len(r) for r, _ in sketch._rows))
    sketch.settle()
    assert (sketch.x[:, 0] == (sketch.h >> np.uint64(11)).astype(float)).all()
    for s in range(len(salt)):
        u = np.concatenate([list(sampling.copies_of(v, 2, salt[s:s + 1], k)) for v in h])[:, 0] if copies == 2 else sampling.numbers(h, salt[s:s + 1])[:, 0]
        of = np.repeat(h, copies)[np.argsort(u, kind="stable")[:k]]
        mine = sketch.sample == s
        assert sorted(sketch.u[mine]) == sorted(u)[:k]
        assert sorted(sketch.h[sketch.at[mine]]) == sorted(of)
    assert held < 4000


@pytest.mark.parametrize("size", [2, 5, 16, 256])
def test_forest_walk_is_the_plain_walk(size):
    rng = np.random.default_rng(3)
    rows = np.column_stack([rng.normal(0, 1, (900, 5)), rng.integers(0, 4, (900, 3)), np.ones(900)])
    levels = max(1, int(np.ceil(np.log2(size))))
    nodes = pd.concat([forest._isolation_tree(t, rows[rng.choice(900, size, replace=False)], levels, 42) for t in range(12)])

    class Nodes:
        def toPandas(self):
            return nodes

    model = forest.Forest(Nodes(), size, 12)
    inner = nodes[nodes.feature >= 0]
    # Values at a threshold go left; beyond all thresholds in both directions.
    rows = np.vstack([rows, np.full((1, 9), np.inf), np.full((1, 9), -np.inf), *[np.full((1, 9), t) for t in inner.threshold[:20]]])
    table = {(r.tree, r.node): r for r in nodes.itertuples()}

    def path(row, tree):
        node = table[tree, 0]
        while node.feature >= 0:
            node = table[tree, 2 * node.node + (2 if row[node.feature] > node.threshold else 1)]
        return node.depth + float(forest.average_path(node.size))

    got = forest._mean_path(list(rows.T), *forest._tables(model))
    assert got == pytest.approx([np.mean([path(row, t) for t in range(12)]) for row in rows], rel=1e-12)
