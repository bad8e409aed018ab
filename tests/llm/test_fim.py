"""Fill-in-the-middle: exact cuts, exact round trips."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from voltledger.llm import fim

LETTERS = ["a", " ", "\n", "é", "語", "😀", "<", "P", ">", "S", "́"]


def expected(doc_id, text, units):
    """By the definition, over Python strings."""
    text = text or ""
    parts = units(text)
    n = len(parts)
    x = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(s in text for s in fim.SENTINELS) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(parts[:a]), "".join(parts[a:b]), "".join(parts[b:])
    if h[3] % 100 < 20:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def words(text):
    return re.findall(r"\A[ \t\n]*[^ \t\n]*[ \t\n]*|[^ \t\n]+[ \t\n]*", text)[: None if text else 0]


def corpus():
    rnd = random.Random(5)
    rows = [(i, "".join(rnd.choice(LETTERS) for _ in range(rnd.randrange(0, 60)))) for i in range(300)]
    rows += [(400 + i, "x" * size + "語" * size) for i, size in enumerate((1, 1023, 1024, 1025, 5000))]
    rows += [(500, None), (501, ""), (None, "no id"), (502, "twice"), (502, "twice"), (503, "a <M> b"), (504, "<<S"), (505, " lead")]
    return rows


@pytest.mark.parametrize("unit, split", [("char", list), ("word", words)])
@pytest.mark.parametrize("block", [1, 7, 1024])
def test_equals_definition_and_round_trips(spark, unit, split, block):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, form string")
    made = fim.transform(docs, unit=unit, block=block).withColumn("back", fim.restored()).collect()
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in made), key=str)
    assert got == sorted(((i, *expected(i, t, split), t or "") for i, t in rows), key=str)
    assert {r.form for r in made} == {"plain", "psm", "spm"}


def test_very_long_text(spark):
    text = "wörd 😀\n" * 400_000
    docs = spark.createDataFrame([(i, text) for i in range(6)], "doc_id long, text string")
    made = fim.transform(docs).withColumn("same", fim.restored() == F.lit(text)).collect()
    want = {i: expected(i, text, list) for i in range(6)}
    assert all(r.same and (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == want[r.doc_id] for r in made)


def test_own_sentinels_and_rates(spark):
    docs = spark.createDataFrame([(i, "some text | here.") for i in range(40)], "doc_id long, text string")
    marks = ("[pre|", "[suf|", "[mid|")
    made = fim.transform(docs, sentinels=marks, fim_percent=100, spm_percent=100).withColumn("back", fim.restored(sentinels=marks)).collect()
    assert all(r.form == "spm" and r.output.startswith("[suf|") and r.back == "some text | here." for r in made)
    for bad in (("<P>", "<P>", "<M>"), ("aba", "<S>", "<M>"), ("<P", "<P>", "<M>"), ("", "<S>", "<M>")):
        with pytest.raises(ValueError):
            fim.transform(docs, sentinels=bad)
    with pytest.raises(ValueError):
        fim.transform(docs, unit="line")


def test_empty_table(spark):
    assert fim.transform(spark.createDataFrame([], "doc_id long, text string")).count() == 0
