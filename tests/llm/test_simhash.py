"""SimHash: fingerprints and components against brute force."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from voltledger.llm import simhash
from voltledger.llm.simhash_queries import op11_simhash_bytes


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(marked, bits=2):
    """(doc_id, fp) rows: smallest id reachable, by a search over all pairs of fingerprints."""
    fps = sorted({f for _, f in marked})
    root = {f: f for f in fps}

    def top(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= bits:
                root[top(a)] = top(b)
    least = {}
    for doc_id, f in marked:
        if doc_id is not None:
            least[top(f)] = min(doc_id, least.get(top(f), doc_id))
    return sorted(((i, f"{f:016x}", least.get(top(f))) for i, f in marked), key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus():
    rnd = random.Random(3)
    vocabulary = [f"Word{i}" for i in range(40)] + ["ß x", " ", "Ä", "İ"]
    rows = []
    for i in range(60):
        words = [rnd.choice(vocabulary) for _ in range(rnd.choice([1, 2, 3, 5, 200]))]
        rows.append((i, " ".join(words)))
        for j in range(3):
            words[rnd.randrange(len(words))] = "other"
            rows.append((100 * (j + 1) + i, rnd.choice([" ", "\t", "\r\n", "\x0b"]).join(words)))
    return rows + [(None, None), (900, None), (901, ""), (902, " \x0c"), (903, "twice the same"), (903, "twice the same"), (None, "only null ids")]


def test_equals_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, fp int")
    want = plain_components([(i, plain_fingerprint(t)) for i, t in rows])
    assert result(simhash.near_duplicates(docs)) == want
    assert result(simhash.near_duplicates(docs.repartition(5), long=2)) == want


def test_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert result(op11_simhash_bytes(spark, sf_dir)) == plain_components([(i, plain_fingerprint(t)) for i, t in docs])


@pytest.mark.parametrize("bits", [1, 2, 3])
@pytest.mark.parametrize("long", [1, 4, 1024])
def test_every_close_pair_is_found_once_or_more(spark, bits, long):
    rnd = random.Random(bits)
    fps = set()
    for _ in range(40):
        base = rnd.getrandbits(64)
        fps.add(base)
        for _ in range(8):
            fps.add(base ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(1, 5))))
    fps |= {0, (1 << 64) - 1, 1 << 63, 3}
    signed = np.array(sorted(fps), dtype=np.uint64).view(np.int64).tolist()
    found = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), bits, long).collect()
    got = {frozenset((r.a % 2**64, r.b % 2**64)) for r in found}
    every = sorted(fps)
    assert got == {frozenset((a, b)) for i, a in enumerate(every) for b in every[:i] if (a ^ b).bit_count() <= bits}


def test_a_crowded_posting_list(spark):
    """Thousands of fingerprints with the same six bytes."""
    signed = [7 << 40 | i for i in range(0, 65536, 13)]
    found = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), long=64).distinct().count()
    a = np.array(signed)
    assert found == sum(int((np.bitwise_count(a[i + 1 :] ^ x) <= 2).sum()) for i, x in enumerate(a))


def test_very_long_texts(spark):
    one = "x" * 3_000_000
    many = "lorem Ipsum dolor\n" * 200_000
    for text in (one, many, one + " " + many):
        assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_plan_covers_every_set_of_wrong_positions():
    for bits in (1, 2, 3):
        masks = simhash.plan(bits)
        for wrong in combinations(range(8), bits):
            bad = sum(0xFF << 8 * p for p in wrong)
            assert any(not (m % 2**64) & bad for m in masks)
            assert all(any(not (y % 2**64) & bad for y in more) for m, more in masks.items() if not (m % 2**64) & bad)


def test_empty_table(spark):
    assert result(simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string"))) == []
