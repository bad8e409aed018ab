"""Packing: exact places, exact ids, target proportions."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from voltledger.llm import packing, tokens

PATH = tokens.tokenizer_path(tokens.WORD_VOCAB)


def plain():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, source string, text string, queue string")


def check(spark, rows, seq_len=64, **options):
    """All pieces of the rows, with everything the contract says of them verified."""
    pieces = packing.pack(frame(spark, rows), seq_len=seq_len, **options).collect()
    ids_of, encode = defaultdict(list), plain()
    for doc_id, _, text in rows:
        ids_of[doc_id].append(encode(text) + [1])
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
    for doc_id, texts in ids_of.items():
        if len(texts) > 1:
            continue
        ids, at = texts[0], 0
        for p in sorted(by_doc[doc_id], key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], dtype="<u4").tobytes())
            at += p.length
        assert at == len(ids)
    assert sum(p.length for p in pieces) == sum(len(x) for xs in ids_of.values() for x in xs)
    windows = defaultdict(list)
    for p in pieces:
        windows[p.sequence_id].append(p)
    for ps in windows.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == seq_len or at & (at - 1) == 0  # full, or a power of two: no padding
    assert sorted(windows) == list(range(len(windows)))
    return windows


def corpus(seed, n=60):
    rnd = random.Random(seed)
    return [(i, rnd.choice("aaaabbc"), " ".join(f"word{rnd.randrange(90)}," for _ in range(rnd.randrange(60)))) for i in range(n)]


@pytest.mark.parametrize("seed", range(2))
def test_every_token_has_one_place(spark, seed):
    rows = corpus(seed)
    windows = check(spark, rows)
    encode = plain()
    total = Counter()
    for _, source, text in rows:
        total[source] += len(encode(text)) + 1
    everything = sum(total.values())
    for ps in windows.values():
        if sum(p.length for p in ps) == 64:
            held = Counter()
            for p in ps:
                held[p.source] += p.length
            for source, n in total.items():
                assert abs(held[source] - 64 * n / everything) <= 3


def test_odd_rows(spark):
    check(spark, [(1, None, None), (2, "", ""), (3, "a", "x " * 3000), (None, "a", "null id"), (4, None, "É <|endoftext|> it's 3,5")])
    check(spark, [(5, "a", "same"), (5, "a", "same"), (6, "b", None)])
    assert packing.pack(frame(spark, [])).collect() == []


def test_sources_beyond_the_queues_share_one(spark):
    rows = [(i, f"s{i % 9}", "some words here " * (i % 9 + 1)) for i in range(40)]
    check(spark, rows, max_queues=3)


def test_rounds_agree_with_a_simulation():
    sizes, seq_len = [1000, 7, 333, 0, 61], 50
    rounds, total = packing.Rounds(sizes, seq_len), sum(sizes)
    sent, credit, stream = [0] * 5, [0] * 5, []  # deficits in units of 1/total
    while len(stream) < total:
        for q, size in enumerate(sizes):
            credit[q] += size * seq_len
            n = min(size - sent[q], credit[q] // total)
            stream += [(q, sent[q] + i) for i in range(n)]
            sent[q] += n
            credit[q] -= n * total
    place = {x: i for i, x in enumerate(stream)}
    for q, size in enumerate(sizes):
        at = 0
        while at < size:
            n = min(17, size - at)
            spots = [p + i for p, length in rounds.runs(q, at, n) for i in range(length)]
            assert spots == [place[q, at + i] for i in range(n)]
            at += n


def test_word_encoder_equals_the_tokenizer():
    encode, ours = plain(), tokens.WordEncoder(PATH)
    rnd = random.Random(4)
    letters = "aB1é'.,!-_ \n\t\x1c\x01\x00́sβΣ<|日ﬁ"
    texts = ["", "it's don't ''s", "ΑΣ ΣΑΣ. İstanbul", "a.b,c 1,000.5 x's, y.'s", "<|endoftext|>", "a" * 3000, "x́. ́y"]
    texts += ["".join(rnd.choice(letters) for _ in range(rnd.randrange(30))) for _ in range(3000)]
    for text, ids in zip(texts, ours.encode(texts), strict=True):
        assert np.frombuffer(ids, dtype="<u4").tolist() == encode(text), text


MARKED = ["a <|endoftext|> b", "É<|startoftext|>\u0301x <|ENDOFTEXT|>", "<|endoftext|><|endoftext|>'s", "<|endoftext|", "x<|startoftext|>", "ΑΣ<|endoftext|>"]


def test_added_tokens_are_those_of_the_file():
    file, ours = Tokenizer.from_file(PATH), tokens.WordEncoder(PATH, added=True)
    rnd = random.Random(5)
    bits = ["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|", "endoftext", "|>", " ", "\n", "é", "\u0301", "Σ", "it's", "3,5", "."]
    texts = MARKED + ["", "plain"] + ["".join(rnd.choice(bits) for _ in range(rnd.randrange(12))) for _ in range(3000)]
    for text, ids in zip(texts, ours.encode(texts), strict=True):
        assert np.frombuffer(ids, dtype="<u4").tolist() == file.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("which", ["op8", "pipeline"])
def test_queries_give_the_ids_of_the_file(spark, tmp_path, which):
    import corpus_pipeline
    from voltledger.llm import packing_queries

    df = frame(spark, [(i, "s", t) for i, t in enumerate(MARKED)])
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = packing_queries.op8_mixture_packing(spark, str(tmp_path)) if which == "op8" else corpus_pipeline.pack(spark, df, "")
    file, pieces = Tokenizer.from_file(PATH), defaultdict(list)
    for p in got.collect():
        pieces[p.doc_id].append(p)
    for i, text in enumerate(MARKED):
        ids = [*file.encode(text, add_special_tokens=False).ids, packing.END_ID]
        for p in pieces[i]:
            assert p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], dtype="<u4").tobytes())
        assert sum(p.length for p in pieces[i]) == len(ids)


def many_sources():
    rnd = random.Random(8)
    return [(i, f"s{i % 12}" if i % 12 else None, " ".join(["some", "words"] * rnd.randrange(40, 60))) for i in range(240)]


def held_and_total(rows, windows):
    total = Counter()
    for _, source, text in rows:
        total[source] += len(plain()(text)) + 1
    full = [ps for _, ps in sorted(windows.items()) if sum(p.length for p in ps) == 256]
    assert len(full) > 50
    return total, [{source: sum(p.length for p in ps if p.source == source) for source in total} for ps in full]


def test_sources_beyond_the_queues_keep_their_proportions(spark):
    rows = many_sources()
    total, windows = held_and_total(rows, check(spark, rows, seq_len=256, max_queues=3))
    everything = sum(total.values())
    done = Counter()
    for i, held in enumerate(windows):
        done.update(held)
    for source, n in total.items():
        assert abs(done[source] - n) <= 256
    # The shared queue goes round within 256 tokens of its own, so four windows hold every source.
    for start in range(0, len(windows) - 4):
        for source, n in total.items():
            share = sum(w[source] for w in windows[start : start + 4]) / 1024
            assert 0.5 * n / everything < share < 1.6 * n / everything


@pytest.mark.parametrize("max_queues", [3, 100])
def test_target_shares_hold_until_a_queue_is_empty(spark, max_queues):
    rows = many_sources()
    total, windows = held_and_total(rows, check(spark, rows, seq_len=256, max_queues=max_queues, shares={"s1": 0.5, None: 0.25}))
    until = int(total["s1"] / 128) - 1
    for held in windows[:until]:
        assert abs(held["s1"] - 128) <= 4 and abs(held[None] - 64) <= 4
    with pytest.raises(ValueError):
        packing.pack(frame(spark, rows), shares={"s1": 1.0}).count()


def test_targets_agree_with_a_simulation():
    sizes, weights, seq_len = [1000, 70, 333], [1, 3, 2], 50
    rounds = packing.Rounds(sizes, seq_len, weights)
    sent, stream, r = [0] * 3, [], 0
    while len(stream) < sum(sizes):
        r += 1
        for q in range(3):
            now = min(sizes[q], weights[q] * seq_len * r // 6)
            stream += [(q, i) for i in range(sent[q], now)]
            sent[q] = now
    place = {x: i for i, x in enumerate(stream)}
    for q, size in enumerate(sizes):
        spots = [p + i for p, length in rounds.runs(q, 0, size) for i in range(length)]
        assert spots == [place[q, i] for i in range(size)]


def test_muldiv_is_exact():
    rnd = random.Random(9)
    for _ in range(2000):
        c = rnd.randrange(1, 1 << rnd.randrange(1, 60))
        q = rnd.randrange(1 << rnd.randrange(1, 49))
        a = rnd.randrange(1, 1 << rnd.randrange(1, 62))
        b = min(q * c // a, (1 << 62) - 1)
        got = packing.muldiv([a], [b], [c])
        assert (int(got[0][0]), int(got[1][0])) == divmod(a * b, c)


def test_many_equal_sources_get_runs_of_several_tokens(spark):
    rows = [(i, f"s{i}", "some words here " * 20) for i in range(300)]
    windows = check(spark, rows, seq_len=256)
    lengths = [p.length for ps in windows.values() for p in ps]
    assert sum(lengths) / len(lengths) > 15


def test_rounds_of_many_queues_are_cheap():
    import time

    rounds = packing.Rounds([10**9] * 2048, 2048)
    one = [np.array([x]) for x in (700, 10**6, 600)]
    rounds.spans(*one)
    start = time.perf_counter()
    row, place, length = rounds.spans(*one)
    assert length.sum() == 600 and time.perf_counter() - start < 0.5


def test_the_word_table_is_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_BYTES", 20_000)
    encode, ours = plain(), tokens.WordEncoder(PATH)
    texts = ["語" * 50_000, "x" * 70_000] + [f"word{i} other{i}" for i in range(400)]
    for text, ids in zip(texts, ours.encode(texts), strict=True):
        assert np.frombuffer(ids, dtype="<u4").tolist() == encode(text)
    for text in texts:
        ours.encode([text])
    assert max(map(len, ours)) <= tokens.CACHE_LETTERS
    assert sum(4 * len(w) + len(x) + tokens._ENTRY_BYTES for w, x in ours.items()) < 21_000


def test_a_very_long_text(spark):
    check(spark, [(1, "a", "some words, here. " * 200_000), (2, "b", "short"), (3, "a", "語" * 100_000)])
