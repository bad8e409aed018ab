"""Winnowing against brute force."""

import random
import re

import pytest

from voltledger.llm import decontamination


def words(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[i : i + n]), set()).add('' if item is None else str(item))
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        out.append((doc_id, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def ours(spark, docs, items):
    d = spark.createDataFrame([(*r, "z") for r in docs], "doc_id long, text string, fp string")
    b = spark.createDataFrame([(*r, "z") for r in items], "item_id long, text string, window string")
    found = decontamination.contamination(d, b).collect()
    assert all(r.contaminated == (r.n_hit > 0) and r.n_items == len(r["items"]) for r in found)
    return sorted([(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in found], key=str)


@pytest.mark.parametrize("seed", range(3))
def test_random_texts_over_few_words(spark, seed):
    rnd = random.Random(seed)
    text = lambda n, k: " ".join(rnd.choice("abcdef"[:k]) for _ in range(n))
    items = [(i, text(rnd.choice([1, 3, 9, 10, 11, 30]) if seed else 12, 6)) for i in range(8)]
    docs = [(i, text(rnd.randrange(60), rnd.choice([2, 6]))) for i in range(40)]
    docs += [(100 + i, f"{text(5, 6)} {items[i % 8][1].upper()}, {text(5, 6)}") for i in range(16)]
    assert ours(spark, docs, items) == brute(docs, items)


def test_odd_rows(spark):
    passage = " ".join(f"w{i}" for i in range(14))
    items = [(1, passage), (2, None), (3, ""), (None, "only three words"), (4, passage), (4, passage)]
    docs = [(1, None), (2, ""), (3, "..."), (None, passage), (5, f"x {passage} y"), (5, f"x {passage} y"), (5, "Only, THREE words!"),
            (6, " ".join(f"w{i}" for i in range(9))), (7, "v " * 30_000 + passage), (8, "é ß 日本 " * 5)]
    assert ours(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    assert ours(spark, [], [(1, "a b c")]) == []
    assert ours(spark, [(1, "a b c")], []) == [(1, 3, 0, [])]


def test_clean_keeps_columns_and_clean_rows(spark):
    passage = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, passage, "s"), (2, "fine", "s"), (None, passage + " x", "s"), (None, None, "s")],
                                 "doc_id long, text string, source string")
    kept = decontamination.clean(docs, spark.createDataFrame([(1, passage)], "item_id long, text string"))
    assert kept.columns == docs.columns and {tuple(r) for r in kept.collect()} == {(2, "fine", "s"), (None, None, "s")}


def test_no_python_on_the_main_path(spark, sf_dir, capsys):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    decontamination.contamination(docs, items).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)
