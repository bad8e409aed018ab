"""Quality, toxicity and language: held-out accuracy, interactions, odd rows."""

import bisect
import collections
import math
import re
import zlib

import numpy as np
import pytest

from voltledger.llm import language, language_queries, quality, quality_queries, toxicity, toxicity_queries

MID = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


def labels_of(spark, column):
    return {r.doc_id: r[column] for r in spark.read.parquet(f"{MID}/labels.parquet").collect()}


def fold(doc_id, k):
    return zlib.crc32(str(doc_id).encode()) % k


def accuracy(rows, truth):
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    return np.mean([a == b for a, b in held])


def test_quality_on_held_out_documents(spark):
    rows = quality_queries.op2_quality_gam(spark, MID).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (fold(r.doc_id, 3) == 1) for r in rows)
    assert accuracy(rows, labels_of(spark, "quality")) > 0.97


def test_toxicity_on_held_out_documents(spark):
    rows = toxicity_queries.op7_toxicity_fm(spark, MID).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) for r in rows)
    assert accuracy(rows, labels_of(spark, "toxic")) > 0.9


def test_language_on_held_out_documents(spark):
    rows = language_queries.op5_language_id(spark, MID).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{MID}/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_pairs_of_features_are_learned():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    without = quality.fit(x, y, n_pairs=0).score(x)
    model = quality.fit(x, y)
    assert np.mean((without > 0.5) == y) < 0.65 < 0.97 < np.mean((model.score(x) > 0.5) == y)
    assert model.pairs[0][:2] == (0, 1)
    # Look-ups alone make the score.
    table = sum(m[np.searchsorted(e, x[:, f], side="right")] for f, (e, m) in enumerate(zip(model.edges, model.main)))
    pairs = sum(v[np.searchsorted(a_, x[:, a], side="right"), np.searchsorted(b_, x[:, b], side="right")] for a, b, a_, b_, v in model.pairs)
    assert np.allclose(1 / (1 + np.exp(-(model.intercept + table + pairs))), model.score(x))


def test_an_insult_counts_only_beside_a_group():
    rng = np.random.default_rng(1)
    rows, y = [], []
    for _ in range(3000):
        terms = set(rng.choice(np.arange(10, 60), 5).tolist())
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        rows.append(np.array(sorted(terms | ({1} if insult else set()) | ({2} if group else set())), dtype=np.int32))
        y.append(float(insult and group))
    model = toxicity.fit(rows, np.array(y), np.arange(1, 60, dtype=np.int32), buckets=64)
    one = lambda *t: model.score([np.array(t, dtype=np.int32)])[0]
    assert one(1, 2, 20) > 0.5 > max(one(1, 20), one(2, 20), one(20))
    # Half of (sum v)^2 - sum v^2 is the sum over pairs.
    t = [1, 2, 20, 33]
    r = model.row_of[t]
    pairs = sum(model.factors[r[i]] @ model.factors[r[j]] for i in range(4) for j in range(i))
    raw = model.bias + model.linear[r].sum() + pairs
    assert np.isclose(one(*t), 1 / (1 + np.exp(-raw)))


ODD = [(1, None, "en"), (2, "", "en"), (3, "   \n", None), (None, "some words here", "en"), (4, "w " * 60_000, "de"), (5, "!!! 123", "de"),
       (6, "same same", "en"), (6, "same same", "en"), (7, "日本語のテキスト", None),
       (8, "words of one kind", "en"), (9, "wörter anderer art", "de")]  # the last two are in the learning fold


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, 9.0) for r in ODD], "doc_id long, text string, lang string, quality_score double")


@pytest.mark.parametrize("marked", [[], [(6, 1, 0), (4, 0, 1), (6, 1, 0), (None, 1, 1), (5, None, None)]])
def test_models_take_odd_rows(spark, odd, marked):
    labels = spark.createDataFrame(marked, "doc_id long, quality int, toxic int")
    for op, name in ((quality, "quality_score"), (toxicity, "toxic_score")):
        model = op.train(odd, labels)
        rows = op.score(odd, model).collect()
        assert len(rows) == len(ODD) and all(0 <= r[name] <= 1 for r in rows)
        if not marked:
            assert {r[name] for r in rows} == {0.5}
        assert op.accepted(odd, model).columns == odd.columns
        none = odd.limit(0)
        assert op.score(none, op.train(none, labels)).collect() == []


def test_language_takes_odd_rows(spark, odd):
    found = {r.doc_id: r for r in language.identify(odd, language.train(odd)).collect()}
    assert [found[i].lang_pred for i in (1, 2, 3, 5)] == ["und"] * 4 and found[1].score == 0
    assert all(found[i].lang_pred in ("en", "de") for i in (4, 6, 7, None))
    none = odd.limit(0)
    assert language.identify(none, language.train(none)).collect() == []
    assert {r.lang_pred for r in language.identify(odd, language.train(none)).collect()} == {"und"}


def test_far_texts_are_rejected(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    model = language.train(docs)
    assert np.bincount(model.of).min() > 1  # several centroids per language
    _, _, _, rejected = model.predict(["日本語のテキストです。" * 20, "".join(map(chr, range(0x400, 0x450))) * 5])
    assert rejected.all()


def test_only_letters_are_letters():
    from voltledger.llm import language

    assert not any(map(language.has_letter, ("½ ²", "①②", "Ⅷ", "12 _ 3", "", None, "٣", "\u0301")))
    assert all(map(language.has_letter, ("a", "1é", "語", "ª", "ʰ")))


def words_of(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())


def sigmoid(x):
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def documents(spark, path):
    return spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")


@pytest.mark.parametrize("rule", ["one without the other", "both"])
def test_neutral_words_are_learned_as_a_pair(spark, rule):
    rng = np.random.default_rng(11)
    pool = ["".join(rng.choice(list("klmnoprstu"), 7)) for _ in range(80)]
    rows, marks = [], []
    for i in range(3000):
        a, b = (rng.random(2) < 0.5).tolist()
        words = [*rng.choice(pool, 9), *["harvest"] * a, *["Lantern"] * b]
        rows.append((i, " ".join(rng.permutation(words))))
        marks.append((i, 0, int(a and b) if rule == "both" else int(a != b)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    found = {r.doc_id: r.toxic_score for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    held = [i for i in found if fold(i, 5) == 0]
    assert np.mean([(found[i] >= 0.5) == marks[i][2] for i in held]) > 0.97
    if rule != "both":
        # Terms of their own signal alone are not enough.
        single = {r.doc_id: r.toxic_score for r in toxicity.score(docs, toxicity.train(docs, labels, min_pair_z=math.inf)).collect()}
        assert np.mean([(single[i] >= 0.5) == marks[i][2] for i in held]) < 0.6


def test_terms_that_add_up_are_no_pair(spark):
    rng = np.random.default_rng(12)
    on = rng.random((4000, 12)) < 0.4
    y = rng.random(4000) < 0.1 + 0.2 * on[:, 0] + 0.2 * on[:, 1]
    rows = [(int(i), int(y[i]), np.flatnonzero(on[i]).astype(np.int32).tobytes()) for i in range(4000)]
    coded = spark.createDataFrame(rows, "doc_id long, label int, terms binary").repartition(5)
    counts, total, ones = toxicity._counts(coded, 16)
    none = np.empty((0, 3), dtype=np.int64)
    assert (total, ones) == (4000, y.sum()) and len(toxicity.paired_terms(coded, counts, total, ones, none, 16, 8.0)) == 0
    # The contrast of every pair, counted plainly: the same pairs are found at any threshold.
    p = ones / total
    z = {}
    for t in range(12):
        for u in range(t + 1, 12):
            sides = [(on[:, t] == a) & (on[:, u] == b) for a, b in ((1, 1), (1, 0), (0, 1), (0, 0))]
            contrast = sum(sign * y[k].mean() for sign, k in zip((1, -1, -1, 1), sides))
            z[t, u] = abs(contrast) / math.sqrt(p * (1 - p) * sum(1 / k.sum() for k in sides))
    limit = sorted(z.values())[-4]
    want = sorted({t for pair, value in z.items() if value >= limit - 1e-9 for t in pair})
    assert toxicity.paired_terms(coded, counts, total, ones, none, 16, limit - 1e-9).tolist() == want


def test_toxicity_equals_the_sum_over_terms_and_pairs(spark):
    docs, labels = documents(spark, SMALL)
    model = toxicity.train(docs, labels)
    for r in toxicity_queries.op7_toxicity_fm(spark, SMALL).join(docs, "doc_id").collect():
        # Words end at ASCII characters, so each is text of its own.
        held = sorted({int(t) for w in words_of(r.text) for t in toxicity.terms(w.decode()) if model.row_of[t]})
        raw = model.bias + sum(model.linear[model.row_of[t]] for t in held)
        raw += sum(float(model.factors[model.row_of[t]] @ model.factors[model.row_of[u]]) for i, t in enumerate(held) for u in held[:i])
        assert math.isclose(r.score, sigmoid(raw), abs_tol=1e-9) and r.predicted == (r.score >= 0.5)


def plain_numbers(text):
    raw = (text or "").encode()
    if not raw:
        return [0.0] * len(quality.FEATURES)
    n, words, lines = len(raw), words_of(text), text.split("\n")
    kinds = ["blank" if c < 33 and (chr(c).isspace() or c < 32) else "letter" if c > 127 or chr(c).islower() else "capital" if chr(c).isupper()
             else "digit" if chr(c).isdigit() else "mark" if chr(c) in ".,;:'\"-?()" else "symbol" for c in raw]
    count = collections.Counter(kinds)
    letters = max(1, count["letter"] + count["capital"])
    runs = "".join("b" if k == "blank" else "x" for k in kinds).split("b")
    symbols = collections.Counter(c for c, k in zip(raw, kinds) if k == "symbol")
    grams = list(zip(words, words[1:], words[2:]))
    return [
        math.log1p(n), count["symbol"] / n, count["capital"] / letters, count["digit"] / n, count["blank"] / n,
        letters / len(words) if words else 0.0, sum(len(r) > 20 for r in runs) / max(1, len(words)),
        len(set(words)) / len(words) if words else 0.0, sum(a == b for a, b in zip(words, words[1:])) / len(words) if words else 0.0,
        1 - len(set(grams)) / len(grams) if len(words) > 3 else 0.0, max(symbols.values(), default=0) / n,
        math.log1p(n / len(lines)), 1 - len(set(lines)) / len(lines), sum(a == b == "symbol" for a, b in zip(kinds, kinds[1:])) / n]


def test_quality_equals_plain_counts_and_look_ups(spark):
    docs, labels = documents(spark, SMALL)
    model = quality.train(docs, labels)
    for r in quality_queries.op2_quality_gam(spark, SMALL).join(docs, "doc_id").collect():
        x = plain_numbers(r.text)
        assert np.allclose(x, quality.text_numbers(r.text), rtol=1e-12, atol=1e-12)
        raw = model.intercept + sum(values[bisect.bisect_right(list(edges), v)] for edges, values, v in zip(model.edges, model.main, x))
        raw += sum(v[bisect.bisect_right(list(ea), x[a]), bisect.bisect_right(list(eb), x[b])] for a, b, ea, eb, v in model.pairs)
        assert math.isclose(r.score, sigmoid(raw), abs_tol=1e-9) and r.predicted == (r.score >= 0.5)


def test_language_equals_plain_cosines(spark):
    docs, _ = documents(spark, SMALL)
    model = language.train(docs)
    shift = 32 - language.DIMS.bit_length() + 1
    for r in language_queries.op5_language_id(spark, SMALL).join(docs, "doc_id").collect():
        data = re.sub(rb" +", b" ", re.sub(rb"[^a-z\x80-\xff]", b" ", f" {r.text} ".encode().lower()))
        grams = collections.Counter()
        for size, salt in ((1, 2 << 24), (2, 1 << 24), (3, 3 << 24)):
            for i in range(len(data) - size + 1):
                grams[(((int.from_bytes(data[i : i + size], "big") + salt) * 0x9E3779B1) & 0xFFFFFFFF) >> shift] += 1
        v = {g: math.log1p(k) * model.idf[g] for g, k in grams.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        best = {}
        for of, centre in zip(model.of, model.centres):
            name = model.languages[of]
            best[name] = max(best.get(name, -1.0), sum(x / norm * float(centre[g]) for g, x in v.items()))
        top = max(best.values())
        assert best[r.lang_pred] > top - 1e-5
        assert math.isclose(r.score, 1 / sum(math.exp(language.SHARPNESS * (b - top)) for b in best.values()), abs_tol=1e-3)
