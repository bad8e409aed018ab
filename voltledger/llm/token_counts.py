"""Token counts of the sections of a document, from one encoding of the whole text.

The text is encoded once; token spans are mapped to UTF-8 bytes and joined with the spans of the
sections (both sorted, so the interval join is a binary search).  A token that crosses a boundary
is given to sections by an explicit rule:

* ``first``    the section that holds its first byte,
* ``largest``  the section that holds most of its bytes, the earlier of equals,
* ``share``    every section it touches, by its share of bytes.

Sections are lines by default: a line owns its line feed.  The sections of a text cover it, so
under each rule their counts sum to the tokens of the whole text.

Defined results: null or empty text is one empty section without tokens; null doc_id and repeated
rows are documents of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltledger.llm import tokens
from voltledger.session import ship_package

RULES = ("first", "largest", "share")
_SCHEMA = "doc_id long, section int, start_byte long, end_byte long, n_tokens double, crossing long, doc_tokens long"


def line_starts(data: bytes) -> np.ndarray:
    """Where sections start: 0 and after every line feed that something follows."""
    after = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 10) + 1
    return np.concatenate(([0], after[after < len(data)]))


def attribute(starts: np.ndarray, ends: np.ndarray, section_starts: np.ndarray, size: int, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Per section: the tokens given to it, and the tokens that cross out of it into the next."""
    n = len(section_starts)
    bounds = np.append(section_starts, size)
    first = np.searchsorted(section_starts, starts, side="right") - 1
    last = np.searchsorted(section_starts, ends - 1, side="right") - 1
    counts = np.bincount(first, minlength=n).astype(float)
    crossing = np.zeros(n, dtype=np.int64)
    for i in np.flatnonzero(first != last):  # few: tokens seldom span a boundary
        a, b = first[i], last[i]
        crossing[a:b] += 1
        if rule == "first":
            continue
        own = np.minimum(ends[i], bounds[a + 1 : b + 2]) - np.maximum(starts[i], bounds[a : b + 1])
        counts[a] -= 1
        if rule == "largest":
            counts[a + int(np.argmax(own))] += 1
        else:
            counts[a : b + 1] += own / (ends[i] - starts[i])
    return counts, crossing


def _count(path: str, rule: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.byte_encoder(path)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                text = text.as_py() or ""
                data = text.encode()
                starts, ends = encoder.spans(text)
                sections = line_starts(data)
                counts, crossing = attribute(starts, ends, sections, len(data), rule)
                n = len(sections)
                yield pa.RecordBatch.from_arrays([
                    pa.repeat(doc_id, n), pa.array(np.arange(n, dtype=np.int32)), pa.array(sections.astype(np.int64)),
                    pa.array(np.append(sections[1:], len(data)).astype(np.int64)), pa.array(counts),
                    pa.array(crossing), pa.array(np.full(n, len(starts), dtype=np.int64)),
                ], names=["doc_id", "section", "start_byte", "end_byte", "n_tokens", "crossing", "doc_tokens"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for one in run(batches):
            held.append(one)
            rows += one.num_rows
            if rows >= 20_000:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, rows = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return joined


def section_tokens(docs: DataFrame, rule: str = "first", tokenizer: str | None = None) -> DataFrame:
    """One row per section: doc_id, section, start_byte, end_byte, n_tokens, crossing, doc_tokens."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    ship_package(docs.sparkSession)
    path = tokenizer or tokens.tokenizer_path(tokens.BYTE_VOCAB)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(_count(path, rule), _SCHEMA)
