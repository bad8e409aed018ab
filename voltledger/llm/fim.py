"""Fill-in-the-middle transformation of whole texts.

A text is seen as its UTF-8 bytes in fixed blocks.  A Fenwick tree over the blocks stores how many
units and how many code points start in each; a binary-lifting descent finds the block in which
the unit after a cut starts, and only that block is searched for the byte.  Units are code points
or words, so the cuts never split a character, and nothing is decoded.

Which cuts and which form a document gets is decided by a hash of its id, in Spark expressions:
the same in every run and under any partitioning.  ``restore`` rebuilds the text from output and
form alone.  It is a narrow map: no shuffle, one text at a time.

Defined results: null or empty text is plain with n 0; a text that holds a sentinel is plain; null
doc_id hashes like an empty id; repeated rows are transformed alike; very long texts are handled
whole, in memory of a few times their bytes; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltledger.llm.slices import by_bytes
from voltledger.session import ship_package

BLOCK = 1024
SENTINELS = ("<P>", "<S>", "<M>")
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True

_OUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary"


def point_starts(data: np.ndarray) -> np.ndarray:
    """Bytes at which a code point starts."""
    return (data & 0xC0) != 0x80


def word_starts(data: np.ndarray) -> np.ndarray:
    """Bytes at which a word starts; blanks belong to the word before them, leading ones to the first."""
    blank = _BLANK[data]
    starts = ~blank
    starts[1:] &= blank[:-1]
    if len(data) and blank[0]:
        starts[np.flatnonzero(starts)[:1]] = False
    starts[:1] = True
    return starts


UNITS = {"char": point_starts, "word": word_starts}


class BlockTree:
    """Fenwick tree over fixed blocks of a text: units and code points that start in each."""

    def __init__(self, raw: bytes, unit: str = "char", block: int = BLOCK):
        self._block, self.size = block, len(raw)
        data = np.frombuffer(raw, dtype=np.uint8)
        self._points = point_starts(data)
        self._units = self._points if unit == "char" else UNITS[unit](data)
        edges = np.arange(0, len(raw), block)
        self._unit_tree, self.n = self._tree(self._units, edges)
        self._point_tree, self.points = (self._unit_tree, self.n) if unit == "char" else self._tree(self._points, edges)

    @staticmethod
    def _tree(starts: np.ndarray, edges: np.ndarray) -> tuple[list[int], int]:
        held = np.add.reduceat(starts, edges, dtype=np.int64) if len(edges) else np.zeros(0, dtype=np.int64)
        upto = np.concatenate([[0], np.cumsum(held)])
        at = np.arange(len(upto))
        # Node i holds the blocks i - lowbit(i) .. i - 1.
        return (upto - upto[at - (at & -at)]).tolist(), int(upto[-1])

    def cut(self, units: int) -> tuple[int, int]:
        """(bytes, code points) before the unit that follows ``units`` units; the whole text after the last."""
        if units >= self.n:
            return self.size, self.points
        at, left, points, blocks = 0, units, 0, len(self._unit_tree) - 1
        step = 1 << (blocks.bit_length() - 1)
        while step:
            if at + step <= blocks and self._unit_tree[at + step] <= left:
                at += step
                left -= self._unit_tree[at]
                points += self._point_tree[at]
            step >>= 1
        start = at * self._block
        inside = np.flatnonzero(self._units[start : start + self._block])
        byte = start + int(inside[left])
        return byte, points + int(np.count_nonzero(self._points[start:byte]))


def _transformer(unit: str, block: int, sentinels: Sequence[str], plain_from: int, spm_below: int):
    prefix, suffix, middle = (s.encode() for s in sentinels)

    def one(raw: bytes, h: Sequence[int]) -> tuple:
        tree = BlockTree(raw, unit, block)
        n = tree.n
        if not raw or any(s in raw for s in (prefix, suffix, middle)) or h[2] % 100 >= plain_from:
            return n, "plain", None, None, raw
        first, last = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        (a, points), (b, more) = tree.cut(first), tree.cut(last)
        head, held, tail = raw[:a], raw[a:b], raw[b:]
        if h[3] % 100 < spm_below:
            return n, "spm", points, more - points, b"".join((suffix, tail, prefix, head, middle, held))
        return n, "psm", points, more - points, b"".join((prefix, head, suffix, tail, middle, held))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            texts = batch.column("raw").cast(pa.large_binary())
            hashes = list(zip(*(batch.column(f"h{i}").to_pylist() for i in range(1, 5)), strict=True))
            for start, stop in by_bytes(texts):
                rows = [one(texts[i].as_py() or b"", hashes[i]) for i in range(start, stop)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, stop - start), *(pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True))],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return run


def _check(sentinels: Sequence[str]) -> None:
    """A sentinel's first character may stand nowhere else in them, so that joins never make one."""
    if len(set(sentinels)) != 3 or not all(sentinels):
        raise ValueError("three different sentinels are needed")
    firsts = {s[0] for s in sentinels}
    if any(c in s[1:] for c in firsts for s in sentinels) or any(a != b and b.startswith(a) for a in sentinels for b in sentinels):
        raise ValueError("a sentinel could arise where others meet a text")


def transform(docs: DataFrame, unit: str = "char", sentinels: Sequence[str] = SENTINELS, seed: int = 1,
              fim_percent: int = 90, spm_percent: int = 20, block: int = BLOCK) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) per document.

    ``form`` is plain, psm (prefix, suffix, middle) or spm (suffix, prefix, middle).
    """
    _check(sentinels)
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {', '.join(UNITS)}")
    ship_package(docs.sparkSession)
    doc_id = F.col("doc_id").cast("long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    number = lambda i: F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}")
    narrow = docs.select(doc_id.alias("doc_id"), F.col("text").cast("string").cast("binary").alias("raw"), *(number(i) for i in range(4)))
    made = narrow.mapInArrow(_transformer(unit, block, sentinels, fim_percent, spm_percent), _OUT)
    return made.withColumn("output", F.col("output").cast("string"))


def restored(output: str | Column = "output", form: str | Column = "form", sentinels: Sequence[str] = SENTINELS) -> Column:
    """The text from which an output was made."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    parts = F.split(output, "|".join(f"\\Q{s}\\E" for s in sentinels), 4)
    piece = lambda i: F.element_at(parts, i)
    return (F.when(form == "psm", F.concat(piece(2), piece(4), piece(3)))
            .when(form == "spm", F.concat(piece(3), piece(4), piece(2))).otherwise(output))
