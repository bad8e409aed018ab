"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of five-word shingles; two are linked where their Jaccard similarity reaches
0.8.  A pair becomes a candidate by agreeing in a band of MinHash values.  Candidates are compared
16 values at a time: after each step the posterior probability (flat prior) that the similarity
reaches the threshold is looked up, and a pair for which it is below ``tolerance`` is dropped.
What is left is verified exactly on the shingle sets.

Copies are never paired: documents with equal shingle sets form one class, and only one of each
takes part.  Neither are pairs ever rows.  Tasks compare blocks of at most ``BLOCK`` against
``BLOCK`` members of a bucket in memory and return, per member, what it is linked to in number
and the smallest member it is connected with; a group of any size is spread over all block pairs.

Steps: (1) signatures; (2) buckets to candidate components, by pruning alone; (3) exact links
inside candidate components, for which the texts of their members are read again; (4) components
of the exact links.

A pair of similarity s shares a band with probability 1 - (1 - s^4)^20, that is 0.99997 at 0.8 and
more above; pruning drops a true pair with probability below 6 x tolerance.

Defined results: a text without words has no shingles, equals nothing and stays alone; fewer than
five words are one shingle; null doc_id takes part, its class is named by the smallest id there is
(null if none); repeated rows are copies of each other; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltledger.llm import texts
from voltledger.llm.components import components
from voltledger.session import ship_package, stage

SHINGLE = 5
THRESHOLD = 0.8
TOLERANCE = 1e-6
BANDS, BAND_ROWS = 20, 4
HASHES, STEP = 96, 16
BLOCK = 512
_PAIRS_AT_ONCE = 200_000

_rng = np.random.default_rng(20240101)
_A = _rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def minhash(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over a set."""
    out = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(shingles), 1024):
        part = shingles[start : start + 1024]
        np.minimum(out, (part[None, :] * _A[:, None] + _B[:, None]).min(1), out=out)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    rows = signature[: BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(BAND_ROWS):
        key = texts.mix(key ^ rows[:, i])
    return key.view(np.int64)


def least_matches(threshold: float, tolerance: float) -> list[int]:
    """After 16, 32, ... values: the fewest matches for which a pair is still worth comparing.

    With a flat prior the posterior that similarity reaches t after m matches among n values is
    P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        total, m = 0.0, 0
        while True:
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= tolerance:
                break
            m += 1
        out.append(m)
    return out


def prune(signatures: np.ndarray, a: np.ndarray, b: np.ndarray, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that no step has dropped."""
    kept_a, kept_b = [], []
    for start in range(0, len(a), _PAIRS_AT_ONCE):
        x, y = a[start : start + _PAIRS_AT_ONCE], b[start : start + _PAIRS_AT_ONCE]
        matches = np.zeros(len(x), dtype=np.int16)
        for k, need in enumerate(least):
            cols = slice(k * STEP, (k + 1) * STEP)
            matches += (signatures[x, cols] == signatures[y, cols]).sum(1, dtype=np.int16)
            alive = matches >= need
            x, y, matches = x[alive], y[alive], matches[alive]
        kept_a.append(x)
        kept_b.append(y)
    return (np.concatenate(kept_a), np.concatenate(kept_b)) if kept_a else (a, b)


def smallest_connected(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Per node the smallest node it is connected with."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def all_pairs(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs inside consecutive groups of these sizes."""
    starts = np.cumsum(sizes) - sizes
    a, b = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
    for size in np.unique(sizes[sizes > 1]):
        i, j = np.triu_indices(size, 1)
        at = starts[sizes == size][:, None]
        a.append((at + i).ravel())
        b.append((at + j).ravel())
    return np.concatenate(a), np.concatenate(b)


def _row_key() -> Column:
    """Tells documents apart by id and text."""
    return F.concat_ws(":", F.col("doc_id").cast("string"), F.hex(F.xxhash64(F.col("text").cast("string"))))


_SIGNED = "row long, doc_id long, k string, set_key binary, bands array<long>, sig binary"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, bands, sigs = [], [], []
        for text in batch.column("text"):
            found = texts.shingle_set(texts.word_hashes(text.as_py())[0], SHINGLE)
            if len(found):
                values = minhash(found)
                keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                bands.append(band_keys(values))
                sigs.append(values.astype(np.uint16).tobytes())
            else:
                keys.append(None)
                bands.append(None)
                sigs.append(None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("doc_id"), batch.column("k"), pa.array(keys, pa.binary()),
             pa.array(bands, pa.list_(pa.int64())), pa.array(sigs, pa.binary())],
            names=["row", "doc_id", "k", "set_key", "bands", "sig"])


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by keys, cut between groups, with the sizes of the groups."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        table = pa.concat_tables(held).combine_chunks()
        change = np.zeros(table.num_rows, dtype=bool)
        for k in keys:
            v = table.column(k).to_numpy()
            change[1:] |= v[1:] != v[:-1]
        starts = np.append(0, np.flatnonzero(change))
        last = int(starts[-1])
        if last:
            yield table.slice(0, last), np.diff(starts)
        held = [table.slice(last)]
    if held:
        yield held[0], np.array([held[0].num_rows])


def _signatures(table: pa.Table, column: str = "sig") -> np.ndarray:
    return np.frombuffer(b"".join(table.column(column).to_pylist()), dtype=np.uint16).reshape(-1, HASHES)


def _connect(least: list[int]):
    """Buckets to (a, b): each member beside the smallest it may be linked with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, sizes in _groups(batches, ["b", "i", "j"]):
            a, b = all_pairs(sizes)
            block, same = table.column("block").to_numpy(), (table.column("i").to_numpy() == table.column("j").to_numpy())
            fit = same[a] | (block[a] != block[b])
            ids, first, back = np.unique(table.column("cid").to_numpy(), return_index=True, return_inverse=True)
            a, b = back[a[fit]], back[b[fit]]
            # The same pair meets in many buckets.
            pairs = np.unique(np.minimum(a, b) * len(ids) + np.maximum(a, b))
            a, b = prune(_signatures(table)[first], pairs // len(ids), pairs % len(ids), least)
            label = smallest_connected(len(ids), a, b)
            moved = np.flatnonzero(label != np.arange(len(ids)))
            yield pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(ids[label[moved]])], names=["a", "b"])

    return run


def _intersections(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sets."""
    if len(a) <= 16:
        return np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(a, b)], dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts > 1
    column_of = np.cumsum(shared) - 1
    used = shared[column]
    owner, column = owner[used], column_of[column[used]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    found = np.zeros(len(a), dtype=np.int64)
    width = 4096
    for start in range(0, int(shared.sum()), width):
        lo, hi = np.searchsorted(column, [start, start + width])
        bits = np.zeros((len(sets), width), dtype=bool)
        bits[owner[lo:hi], column[lo:hi] - start] = True
        packed = np.packbits(bits, axis=1).view(np.uint64)
        for at in range(0, len(a), 50_000):
            part = slice(at, at + 50_000)
            found[part] += np.bitwise_count(packed[a[part]] & packed[b[part]]).sum(1, dtype=np.int64)
    return found


def _verify(least: list[int], threshold: float):
    """Block pairs of candidate components to (cid, links, root)."""

    def one(table: pa.Table) -> pa.RecordBatch:
        ids, first = np.unique(table.column("cid").to_numpy(), return_index=True)
        table = table.take(pa.array(first))
        sets = [texts.shingle_set(texts.word_hashes(t.as_py())[0], SHINGLE) for t in table.column("text")]
        sizes = np.array([len(s) for s in sets])
        block, copies = table.column("block").to_numpy(), table.column("copies").to_numpy()
        a, b = np.triu_indices(len(ids), 1)
        fit = np.minimum(sizes[a], sizes[b]) >= threshold * np.maximum(sizes[a], sizes[b]) - 1e-9
        if table.column("i")[0].as_py() != table.column("j")[0].as_py():
            fit &= block[a] != block[b]
        a, b = prune(_signatures(table), a[fit], b[fit], least)
        common = _intersections(sets, a, b)
        linked = common >= threshold * (sizes[a] + sizes[b] - common) - 1e-9
        a, b = a[linked], b[linked]
        links = np.bincount(a, weights=copies[b], minlength=len(ids)) + np.bincount(b, weights=copies[a], minlength=len(ids))
        label = smallest_connected(len(ids), a, b)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids), pa.array(links.astype(np.int64)), pa.array(ids[label])], names=["cid", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, sizes in _groups(batches, ["comp", "i", "j"]):
            held, start = [], 0
            for size in sizes:
                held.append(one(table.slice(start, int(size))))
                start += int(size)
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return run


def _block_pairs(df: DataFrame, size: str, block: int) -> DataFrame:
    """Each row once for every pair of blocks (i <= j) of its group that its own block is part of."""
    n = F.ceil(F.col(size) / block).cast("int")
    df = df.withColumn("block", F.pmod(F.hash("cid"), n))
    other = F.explode(F.sequence(F.lit(0), n - 1)).alias("_o")
    return df.select("*", other).withColumns(
        {"i": F.least("block", "_o"), "j": F.greatest("block", "_o")}).drop("_o", size)


def join(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, block: int = BLOCK) -> DataFrame:
    """One row per document row.

    doc_id; class_id, the smallest doc_id among all documents it is connected with by links;
    copy_id, the smallest doc_id with an equal shingle set; n_links, the number of documents it is
    linked with; and the internal k (id and text hash), row and first_row (the smallest row of its class).
    """
    ship_package(docs.sparkSession)
    least = least_matches(threshold, tolerance)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    named = narrow.withColumn("k", _row_key())
    signed = stage(named.withColumn("row", F.monotonically_increasing_id()).mapInArrow(_sign, _SIGNED), "signatures")

    classes = signed.where("set_key IS NOT NULL").groupBy("set_key").agg(
        F.min("row").alias("cid"), F.count("*").alias("copies"), F.min("doc_id").alias("copy_id"))
    classes = stage(classes, "classes")
    reps = stage(signed.join(classes.select("cid", "copies"), signed["row"] == F.col("cid")).select(
        "cid", "copies", "k", "bands", "sig"), "class-heads")

    banded = reps.select("cid", F.explode("bands").alias("b"))
    buckets = banded.groupBy("b").agg(F.count("*").alias("n")).where("n > 1")
    members = _block_pairs(banded.join(buckets, "b"), "n", block).join(reps.select("cid", "sig"), "cid")
    near = members.repartition("b", "i", "j").sortWithinPartitions("b", "i", "j").select("b", "i", "j", "block", "cid", "sig")
    candidates = components(near.mapInArrow(_connect(least), "a long, b long"))

    candidates = stage(candidates.select(F.col("node").alias("cid"), F.col("root").alias("comp")), "candidates")
    sizes = candidates.groupBy("comp").agg(F.count("*").alias("n"))
    wanted = candidates.join(sizes, "comp").join(reps.select("cid", "k", "copies", "sig"), "cid")
    # Both sides grow with the corpus: a shuffle join at every size.  Repeated rows have one k; each task sends one of them.
    with_text = named.select("k", "text").dropDuplicates(["k"]).join(wanted.hint("merge"), "k").drop("k")
    compared = _block_pairs(with_text, "n", block).repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j")
    verified = stage(compared.select("comp", "i", "j", "block", "cid", "copies", "sig", "text").mapInArrow(
        _verify(least, threshold), "cid long, links long, root long"), "links")

    links = verified.groupBy("cid").agg(F.sum("links").alias("links"))
    groups = components(verified.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    per_class = classes.join(links, "cid", "left").join(
        groups.select(F.col("node").alias("cid"), "root"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    names = per_class.groupBy("root").agg(F.min("copy_id").alias("class_id"), F.min("cid").alias("first_row"))
    per_class = stage(per_class.join(names, "root").select(
        "set_key", "copy_id", "class_id", "first_row",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "class-links")

    rows = signed.select("row", "doc_id", "k", "set_key")
    alone = rows.where("set_key IS NULL").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_id"), F.lit(0).cast("long").alias("n_links"),
        "k", "row", F.col("row").alias("first_row"))
    return rows.join(per_class, "set_key").select(
        "doc_id", "class_id", "copy_id", "n_links", "k", "row", "first_row").unionByName(alone)


def first_of_each_class(docs: DataFrame, **options) -> DataFrame:
    """One document of every class, columns unchanged."""
    kept = stage(join(docs, **options).where("row = first_row").select("k"), "kept")
    own = next(name for name in ("_k", *(f"_k{i}" for i in range(len(docs.columns)))) if name not in docs.columns)
    marked = docs.withColumn(own, _row_key())
    once = marked.join(kept.hint("merge"), marked[own] == kept["k"], "left_semi")
    # A repeated row has the same key as the one that stays.
    return once.dropDuplicates([own]).drop(own)
