"""SimHash near-duplicates through an inverted index of positional bytes.

A fingerprint has eight bytes.  Two fingerprints that differ in at most ``bits`` bits share at least
``8 - bits`` positional bytes (byte value and position): the guaranteed minimum a pair must reach.

* Index.  Positions are cut into ``bits + 2`` groups; wrong bytes touch at most ``bits`` of them, so
  a linked pair agrees on two whole groups.  Every distinct fingerprint is posted once per pair of
  groups under those bytes (six postings for two bits), so a posting list starts with a common
  tally of four instead of one and lists of unrelated fingerprints stay short.
* Lists of one are dropped by counting keys before anything else moves.  A list above ``LONG`` is
  posted again under every larger set of positions that still reaches the minimum; such a list
  differs in ``bits`` bytes only and so holds at most 256 ** bits fingerprints, however skewed the corpus.
* Count filter.  Within a list the remaining positions are tallied for every pair, block by block;
  pairs that reach the minimum are verified by their differing bits, all others are dropped.

Only distinct fingerprints (8 bytes) are indexed; copies meet in a map-side combined count.  Linked
fingerprints become components; documents get their component by a join in which rows of frequent
fingerprints are not moved.  Pairs never become rows of documents.

Defined results: texts without words (null, empty, blanks) have fingerprint zero and are linked like
any other; fewer words than a shingle are one shingle; repeated rows count as documents; a null doc_id
is never a component's id (null only if all ids of the component are); very long texts are hashed in
blocks; ties do not arise; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltledger.llm.components import components
from voltledger.llm.hot import hot_keys, join_lookup
from voltledger.llm.slices import by_bytes
from voltledger.session import ship_package, stage

SEED, SHINGLE, BITS = 42, 3, 2
BYTES = 8
# Longer posting lists are posted again under more positions.
LONG = 1024
_BLOCK, _AT_ONCE, _CELLS = 1 << 20, 1 << 16, 1 << 22
_BLANK = re.compile(rb"[\x20\x09-\x0d]")


def _shingles(raw: bytes, k: int) -> Iterator[bytes]:
    """k consecutive words joined by one blank; a text of fewer words is one shingle, none is none."""
    held: list[bytes] = []
    start, short = 0, True
    while start < len(raw):
        cut = _BLANK.search(raw, start + _BLOCK) if len(raw) - start > _BLOCK else None
        stop = cut.start() if cut else len(raw)
        words = held + raw[start:stop].lower().split()  # bytes: A-Z and the six ASCII blanks only
        if len(words) >= k:
            short = False
            yield from map(b" ".join, zip(*(words[i:] for i in range(k))))
            held = words[len(words) - k + 1 :]
        else:
            held = words
        start = stop
    if short and held:
        yield b" ".join(held)


def fingerprint(raw: bytes | None, k: int = SHINGLE, seed: int = SEED) -> int:
    """Bit i is set if it is set in more than half the shingle hashes."""
    digest, shingles = xxhash.xxh64_intdigest, _shingles(raw or b"", k)
    ones, n = np.zeros(64, dtype=np.int64), 0
    while len(h := np.fromiter((digest(s, seed) for s in islice(shingles, _AT_ONCE)), dtype="<u8")):
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(h)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, k: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, fp): the fingerprint's 64 bits as a long."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("raw").cast(pa.large_binary())
            for start, stop in by_bytes(texts):
                found = np.fromiter((fingerprint(texts[i].as_py(), k, seed) for i in range(start, stop)), dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, stop - start), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("raw"))
    return narrow.mapInArrow(run, "doc_id long, fp long")


def _mask(positions: tuple[int, ...]) -> int:
    """The bytes at these positions as a signed long."""
    x = sum(0xFF << 8 * p for p in positions)
    return x - (1 << 64) if x >> 63 else x


def plan(bits: int) -> dict[int, list[int]]:
    """Masks of the first postings, and for each the masks that extend it to the guaranteed minimum."""
    if not 1 <= bits <= 3:
        raise ValueError("bits must be 1, 2 or 3")
    groups = [tuple(map(int, g)) for g in np.array_split(np.arange(BYTES), bits + 2)]
    found = {}
    for a, b in combinations(groups, 2):
        rest = [p for p in range(BYTES) if p not in a + b]
        found[_mask(a + b)] = [_mask(a + b + more) for more in combinations(rest, BYTES - bits - len(a + b))]
    return found


def _posted(fps: DataFrame, masks: Column) -> DataFrame:
    """One row per fingerprint and mask: the bytes it is posted under."""
    one = F.transform(masks, lambda m: F.struct(m.alias("mask"), F.col("fp").bitwiseAND(m).alias("bytes")))
    return fps.select("fp", F.explode(one).alias("p")).select("p.mask", "p.bytes", "fp")


def linked_in(mask: int, fps: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a posting list (distinct fingerprints) that pass the count filter and the verification."""
    data = fps.view(np.uint8).reshape(-1, BYTES)
    shared = np.frombuffer(int(mask).to_bytes(8, "little", signed=True), dtype=np.uint8) != 0
    rest = [np.ascontiguousarray(data[:, p]) for p in np.flatnonzero(~shared)]
    step = max(1, _CELLS // len(fps))
    for start in range(0, len(fps), step):
        stop = min(start + step, len(fps))
        tally = np.full((stop - start, len(fps) - start), shared.sum(), dtype=np.uint8)
        for column in rest:
            tally += column[start:stop, None] == column[None, start:]
        i, j = np.nonzero(np.triu(tally >= BYTES - bits, 1))
        a, b = fps[start + i], fps[start + j]
        near = np.bitwise_count(a ^ b) <= bits
        if near.any():
            yield a[near], b[near]


def _tally(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(key, parts):
            fps = np.unique(np.concatenate(parts))
            for a, b in linked_in(key[0], fps, bits) if len(fps) > 1 else ():
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        held, parts = None, []
        for batch in batches:
            mask, key, fp = (batch.column(c).to_numpy() for c in ("mask", "bytes", "fp"))
            if not len(fp):
                continue
            edges = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
            for start, stop in zip([0, *edges], [*edges, len(fp)]):
                group = (int(mask[start]), int(key[start]))
                if group != held:
                    if parts:
                        yield from links(held, parts)
                    held, parts = group, []
                parts.append(fp[start:stop].view(np.uint64))
        if parts:
            yield from links(held, parts)

    return run


def links(fps: DataFrame, bits: int = BITS, long: int = LONG) -> DataFrame:
    """(a, b): pairs of the distinct fingerprints ``fp`` that differ in at most ``bits`` bits."""
    spark = fps.sparkSession
    ship_package(spark)
    masks = plan(bits)
    first = _posted(fps, F.array(*(F.lit(m) for m in masks)))
    lists = stage(first.groupBy("mask", "bytes").agg(F.count("*").alias("n")).where("n > 1"), "posting-lists")
    kept = first.join(lists, ["mask", "bytes"])
    wider = F.create_map(*(x for m, more in masks.items() for x in (F.lit(m), F.array(*(F.lit(y) for y in more)))))
    again = F.when(F.col("n") > long, F.element_at(wider, F.col("mask"))).otherwise(F.array("mask"))
    posted = _posted(kept.select("fp", again.alias("masks")), F.col("masks"))
    order = ["mask", "bytes", "fp"]
    return posted.repartition("mask", "bytes").sortWithinPartitions(*order).mapInArrow(_tally(bits), "a long, b long")


def near_duplicates(docs: DataFrame, k: int = SHINGLE, bits: int = BITS, seed: int = SEED, long: int = LONG) -> DataFrame:
    """(doc_id, fingerprint, component_id) per document: the smallest doc_id reachable over links."""
    marked = stage(fingerprints(docs, k, seed), "fingerprints")
    fps = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "distinct-fingerprints")
    joined = stage(components(links(fps.select("fp"), bits, long)), "fingerprint-components")
    least = joined.join(fps, joined["node"] == fps["fp"]).groupBy("root").agg(F.min("least").alias("component_id"))
    linked = joined.join(least, "root").select(F.col("node").alias("fp"), "component_id")
    named = stage(fps.join(linked.withColumn("linked", F.lit(True)), "fp", "left").select(
        "fp", "n", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("least")).alias("component_id")), "fingerprint-names")
    out = join_lookup(marked, named.select("fp", "component_id"), "fp", hot_keys(named.select("fp", "n")))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
