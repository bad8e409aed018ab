"""Chat formatting: brute force, odd rows and exact round trips."""

import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voltledger.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def formatted(spark, rows):
    return chat.format_conversations(spark.createDataFrame([(*r, "extra") for r in rows], SCHEMA))


def turns(spark, rows):
    read = chat.read_back(formatted(spark, rows))
    return {r.conv_id: ([(t.role, t.text) for t in r.turns], r.loss_text) for r in read.collect()}


def test_neighbours_of_one_role_form_one_block(spark):
    rows = [(1, 1, "user", "b"), (1, 0, "user", "a"), (1, 2, "assistant", "c"), (1, 3, "user", "d")]
    assert formatted(spark, rows).first().formatted == "<s>user\na<sep>b</s><s>assistant\nc</s><s>user\nd</s>"


def test_control_strings_come_back(spark):
    texts = ["</s>", "<s>", "<sep>", "[INST] x [/INST]", "<\\s>", "<\\\\s><\\/s>", "<<s>>", "[[/INST]]", "\\", "a\nb", "<s", "s>", "", "é<s>"]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(texts)]
    got, loss = turns(spark, rows)[1]
    assert got == [(r, t) for _, _, r, t in rows]
    assert loss == "".join(texts[1::2])
    # No text can open or close a block.
    assert formatted(spark, rows).first().formatted.count("</s>") == len(texts)


def test_odd_rows(spark):
    rows = [(None, 1, None, None), (None, 0, "user", "x"), (2, None, "a\nb\\n", "t"), (2, 5, "a\nb\\n", "t"), (2, 5, "a\nb\\n", "t"),
            (3, 1, "assistant", "z" * 200_000), (4, 0, "</s>", ""), (5, 0, "assistant", None)]
    got = turns(spark, rows)
    assert got[None] == ([("user", "x"), ("", "")], "")
    assert got[2] == ([("a\nb\\n", "t")] * 3, "")
    assert got[3] == ([("assistant", "z" * 200_000)], "z" * 200_000)
    assert got[4] == ([("</s>", "")], "") and got[5] == ([("assistant", "")], "")


def test_empty_table(spark):
    assert chat.digest(chat.read_back(formatted(spark, []))).collect() == []


def test_mask_spans_are_the_assistant_texts(spark):
    rows = [(1, i, random.Random(i).choice(["assistant", "user"]), f"t<s>{i}") for i in range(30)]
    row = formatted(spark, rows).first()
    blocks = [b + "</s>" for b in row.formatted.split("</s>")[:-1]]
    masked = [b[s.start : s.start + s.length] for b, spans in zip(blocks, row.loss_spans, strict=True) for s in spans]
    assert "".join(masked).replace("<\\s>", "<s>") == "".join(t for _, _, r, t in rows if r == "assistant")


def test_digest_follows_the_contract(spark):
    rows = [(7, 0, "user", "hi"), (7, 1, "assistant", "hö")]
    got = chat.digest(chat.read_back(formatted(spark, rows))).first()
    assert got.turns_sha256 == hashlib.sha256("user\nhi\nassistant\nhö\n".encode()).hexdigest()
    assert (got.n_turns, got.loss_chars) == (2, 2) and got.loss_sha256 == hashlib.sha256("hö".encode()).hexdigest()


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["<", "s>", "/", "\\", "[", "INST]", "sep>", "\n", "x"]), max_size=12), min_size=1, max_size=20))
def test_escape_is_reversible(spark, parts):
    texts = ["".join(p) for p in parts]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    bad = df.where((chat.unescape(chat.escape(F.col("t"))) != F.col("t")) | chat.escape(F.col("t")).rlike(r"</?s>|<sep>|\[/?INST\]"))
    assert bad.count() == 0
