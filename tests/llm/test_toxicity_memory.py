"""Scoring holds the factors of a bounded number of terms, whatever a batch holds."""

import tracemalloc

import numpy as np

from voltledger.llm import texts, toxicity


def model(terms, buckets=1 << 14):
    rng = np.random.default_rng(3)
    row_of = np.zeros(buckets, dtype=np.int32)
    row_of[:terms] = np.arange(1, terms + 1)
    factors = rng.normal(0, 0.05, (terms + 1, toxicity.RANK))
    factors[0] = 0
    return toxicity.FactorizationMachine(buckets, -0.3, row_of, rng.normal(0, 0.1, terms + 1), factors)


def test_scores_do_not_depend_on_portions():
    m, rng = model(4096), np.random.default_rng(5)
    docs = [np.sort(rng.choice(1 << 14, n, replace=False)).astype(np.int32) for n in (0, 9000, 3, 0, 400, 16_000, 0)] * 9
    whole = np.concatenate([m.row_of[d] for d in docs])
    expected = texts.sigmoid(toxicity._raw(m, whole, np.array([len(d) for d in docs]))[0])
    assert np.array_equal(m.score(docs), expected)
    assert len(m.score([])) == 0


def test_scoring_many_documents_of_frequent_terms_takes_little_memory():
    m = model(4096)
    docs = [np.arange(600, dtype=np.int32)] * 5000  # 3 million terms, 192 MB of factors
    tracemalloc.start()
    try:
        m.score(docs)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 40e6
