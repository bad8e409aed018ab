"""Token attribution against a plain walk over bytes."""

import base64

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from voltledger.llm import token_counts, tokens


def lengths(text):
    with open(tokens.tokenizer_path(tokens.BYTE_VOCAB), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return [len(b) for b in enc.decode_tokens_bytes(enc.encode_ordinary(text))]


def brute(text, rule):
    text = text or ""
    parts = [x for x in text.encode().split(b"\n")]
    sections = [x + b"\n" for x in parts[:-1]] + ([parts[-1]] if parts[-1] or len(parts) == 1 else [])
    owner = [i for i, s in enumerate(sections) for _ in s]
    counts, at = [0.0] * len(sections), 0
    for n in lengths(text):
        own = owner[at : at + n]
        at += n
        if rule == "first":
            counts[own[0]] += 1
        elif rule == "largest":
            counts[max(sorted(set(own)), key=own.count)] += 1
        else:
            for s in own:
                counts[s] += 1 / n
    return [round(c, 9) for c in counts]


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_rules(spark, rule):
    texts = ["", None, "one line", "a\n\n\nb", "\n\n", "x \n \n  y\n", "日本\n語 é\n", "w " * 20_000 + "\nend", "tail\n"]
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)] + [(None, "n\n", 5)], "doc_id long, text string, section int")
    rows = token_counts.section_tokens(df, rule).collect()
    for i, text in enumerate(texts):
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.section)
        assert [round(r.n_tokens, 9) for r in own] == brute(text, rule), text
        assert [r.start_byte for r in own][1:] == [r.end_byte for r in own][:-1]
        assert own[-1].end_byte == len((text or "").encode()) and own[0].doc_tokens == len(lengths(text or ""))
    assert len([r for r in rows if r.doc_id is None]) == 1


def test_a_token_over_several_sections():
    starts, ends = np.array([0, 2]), np.array([2, 9])
    first, crossing = token_counts.attribute(starts, ends, np.array([0, 3, 5]), 9, "first")
    assert first.tolist() == [2, 0, 0] and crossing.tolist() == [1, 1, 0]
    assert token_counts.attribute(starts, ends, np.array([0, 3, 5]), 9, "largest")[0].tolist() == [1, 0, 1]
    assert np.allclose(token_counts.attribute(starts, ends, np.array([0, 3, 5]), 9, "share")[0], [1 + 1 / 7, 2 / 7, 4 / 7])


def test_empty_table_and_wrong_rule(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.section_tokens(df).collect() == []
    with pytest.raises(ValueError):
        token_counts.section_tokens(df, "half")


def test_long_runs_are_cut_by_the_rule_of_the_pattern(monkeypatch):
    encoder = tokens.ByteEncoder(tokens.tokenizer_path(tokens.BYTE_VOCAB))
    runs = [" ", "\t", "\n", " \n", "\u3000", "\r\n\x85"]
    texts = [a + run * n + b for a in ("", "word", "\x1c") for run in runs for n in (40, 150) for b in ("", "x", "!", "\x1c", " tail" + run * 90)]
    whole = [encoder._encoding.encode_ordinary(t) for t in texts]
    monkeypatch.setattr(tokens, "LONG_BLANKS", 30)
    monkeypatch.setattr(tokens, "_LONG_BLANKS", tokens.regex.compile(tokens._LONG_BLANKS.pattern.replace("100001", "31")))
    for text, ids in zip(texts, whole, strict=True):
        assert encoder.ids(text).tolist() == ids


def test_runs_of_a_million_blanks(spark):
    n = 1_200_000
    texts = [a + c * n + b for c in " \t\n" for a, b in (("word", ""), ("word", "x"))] + [" " * n + "\n" + "\t" * n + "end"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    rows = token_counts.section_tokens(df, "largest").groupBy("doc_id").agg(
        {"n_tokens": "sum", "end_byte": "max", "doc_tokens": "max", "section": "count"}).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["sum(n_tokens)"] == r["max(doc_tokens)"] > 0 and r["max(end_byte)"] == len(texts[r.doc_id])
    assert {r.doc_id: r["count(section)"] for r in rows}[5] == n + 1
