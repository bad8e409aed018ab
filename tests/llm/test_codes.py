"""Vector codes: equal to plain Lloyd over every entry; trees whole and exact."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from voltledger.llm import anchors, codes

NAN, INF = float("nan"), float("inf")


def plain(rows, scale=4096, parts=8, entries=16, rounds=6):
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    width = max(1, -(-max(len(v) for _, v, _ in kept) // parts))
    from fractions import Fraction

    cut = lambda v: [math.floor(Fraction(x) * scale) for x in v] + [0] * (width * parts - len(v))
    whole = [(i, cut(v), label) for i, v, label in kept]
    seeds = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v)[p * width : (p + 1) * width] for _, v, _ in seeds] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, z)), e) for e, z in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            held = defaultdict(list)
            for _, v, _ in whole:
                x = v[p * width : (p + 1) * width]
                held[near(x, books[p])[1]].append(x)
            books[p] = [[sum(c) // len(held[e]) for c in zip(*held[e])] if held[e] else z for e, z in enumerate(books[p])]
    sha = hashlib.sha256(",".join(str(c) for b in books for z in b for c in z).encode()).hexdigest()
    out, by_label = [], defaultdict(int)
    for i, v, label in whole:
        found = [near(v[p * width : (p + 1) * width], books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        by_label[label] += error
        out.append([i, "".join(f"{e:02x}" for _, e in found), error, label])
    long = lambda x: x if x < 1 << 63 else None
    wide = {label for _, _, e, label in out if e >= 1 << 63}
    return sorted(((i, c, long(e), str(e), None if label in wide else long(by_label[label]), sha) for i, c, e, label in out), key=str)


def ours(spark, rows, kind="double", **options):
    table = spark.createDataFrame([(*r, "x") for r in rows], f"vec_id long, embedding array<{kind}>, label int, code string")
    return sorted((tuple(r) for r in codes.compress(table, **options).collect()), key=str)


def cloud(seed, n=150, dims=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dims))
    return [(int(i), (centres[i % 5] + rng.normal(size=dims) / 4).tolist(), int(i % 3)) for i in range(n)]


@pytest.mark.parametrize("block", [7, 4096])
def test_equals_plain_lloyd(spark, block):
    rows = cloud(1)
    rows += [(3, rows[3][1], 1), (3, rows[9][1], None), (None, rows[5][1], None), (500, None, 1), (501, [NAN] * 16, 1), (502, [INF] * 16, 1),
             (503, [None] + [0.5] * 15, 1), (504, [0.25] * 5, 2), (505, [], 2)] + [(600 + i, [0.5] * 16, 9) for i in range(80)]
    assert ours(spark, rows, block=block) == plain(rows)


def test_ties_and_copies(spark):
    rows = [(i, [float(i % 2), float(i % 3)] * 4, 0) for i in range(60)]
    assert ours(spark, rows) == plain(rows)
    rows = [(i, [1.5] * 8, None) for i in range(50)]
    assert ours(spark, rows) == plain(rows)


@pytest.mark.parametrize("size", [1e6, 1e16, 1e30, 1e300])
def test_large_components(spark, size):
    rows = cloud(2, n=40, dims=8)
    rows += [(100, [size] * 8, 0), (101, [-size] * 8, 7), (102, [size, -size] * 4, 7)]
    assert ours(spark, rows) == plain(rows)


def test_few_rows_and_none(spark):
    rows = cloud(3, n=4)
    assert ours(spark, rows) == plain(rows)
    assert ours(spark, []) == [] and ours(spark, [(1, None, 1)]) == []


def test_trees_are_whole_and_save_comparisons():
    rng = np.random.default_rng(4)
    x = np.concatenate([np.floor(rng.normal(c, 40, size=(500, 4))) for c in rng.normal(0, 4000, size=(8, 4))]).astype(np.int64)
    balls = anchors.build(x)
    assert sorted(balls.order) == list(range(len(x)))
    for i in range(len(balls.start)):
        members = x[balls.order[balls.start[i] : balls.stop[i]]]
        assert (balls.total[i] == members.sum(0)).all()
        assert np.sqrt(((members - balls.centre[i]) ** 2).sum(1)).max() <= balls.radius[i] * (1 + 1e-9) + 1e-6
        if balls.left[i] >= 0:
            a, b = balls.left[i], balls.right[i]
            assert (balls.start[a], balls.stop[a], balls.stop[b]) == (balls.start[i], balls.start[b], balls.stop[i])
    entries = x[::500]
    nearest, sums, counts, singly = anchors.assign(x, balls, entries)
    want = anchors.squares(x, entries).argmin(1)
    assert (nearest == want).all() and (counts == np.bincount(want, minlength=len(entries))).all()
    assert (sums == np.stack([x[want == e].sum(0) for e in range(len(entries))])).all()
    assert singly < len(x) // 10


def test_limbs():
    for x in (0, 1, -1, 2**40, -(2**40), 2**63, -(2**200) + 5, 3**150):
        parts = list(codes.limbs(x))
        assert sum(p << 40 * i for i, p in enumerate(parts)) == x and all(abs(p) <= 2**40 for p in parts)
