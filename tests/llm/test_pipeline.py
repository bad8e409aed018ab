"""The pipeline against the operators' own answers, stage by stage."""

import random
from collections import Counter

import pytest

import corpus_pipeline
from oracle import compare, connect
from test_decontamination import brute as leaks
from test_jaccard import brute as near
from voltledger.llm import quality, toxicity

MID = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_are_named_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_copies", "decontamination", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None and corpus_pipeline.QUERIES["pipeline"]


@pytest.mark.parametrize("step,op,score,keep", [
    (corpus_pipeline.keep_good, quality, "quality_score", lambda s: s >= 0.5),
    (corpus_pipeline.drop_toxic, toxicity, "toxic_score", lambda s: s < 0.5)])
def test_filters_take_out_what_the_scores_say(spark, step, op, score, keep):
    docs, labels = (spark.read.parquet(f"{MID}/{t}.parquet") for t in ("documents", "labels"))
    kept = step(spark, docs, MID)
    assert kept.columns == COLUMNS
    expected = Counter(r.doc_id for r in op.score(docs, op.train(docs, labels)).collect() if keep(r[score]))
    assert Counter(r.doc_id for r in kept.select("doc_id").collect()) == expected and 500 < len(expected) < 1000


def test_whole_run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in corpus_pipeline.STAGES[:2]:
        docs = step(spark, docs, sf_dir)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    classes = {c for _, c, _, _ in near(rows)}
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {d for d, _, hit, _ in leaks([r for r in rows if r[0] in classes], items) if not hit}
    packed = {r.doc_id for r in corpus_pipeline.run(spark, sf_dir).select("doc_id").distinct().collect()}
    assert packed == clean


def test_odd_documents(spark):
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (2, "plain words in a row " * 30, "en", "s", 9), (2, "plain words in a row " * 30, "en", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, "/root/testdata/sf0.001")
        if name != "packing":
            assert docs.columns == COLUMNS
    docs.collect()
    none = spark.createDataFrame([], docs.sparkSession.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").schema)
    for _, step in corpus_pipeline.STAGES:
        none = step(spark, none, "/root/testdata/sf0.001")
    assert none.collect() == []


@pytest.mark.parametrize("name", sorted(corpus_pipeline.SQL))
def test_query_equals_sql(spark, name):
    random.seed(0)
    problem = compare(corpus_pipeline.QUERIES[name](spark, MID).toPandas(), connect(MID).execute(corpus_pipeline.SQL[name]).df())
    assert problem is None, problem
