"""Mixture-controlled packing: deficit round-robin over source queues into fixed sequences.

Every source is a queue of its documents' tokens.  In each round a queue earns
``seq_len x share`` tokens of credit and sends the whole tokens of its credit; the fraction stays
as its deficit for the next round.  A queue of T_s tokens out of T has therefore sent exactly
``floor(T_s * seq_len * r / T)`` tokens before round r, whatever partition looks at it: rounds need
no state handed on, deficits carry over windows and partitions by arithmetic, and all queues run
empty together in the last round.  The rounds one after another are one token stream, which is cut
every ``seq_len`` tokens.  A window covers the end of one round and the start of the next, so it
holds every queue's share to within a few tokens.

The tokens that do not fill a last sequence are cut into sequences whose lengths are powers of two
(largest first); these need no padding, so nothing is padded at all.

Steps: tokens are written once with the place of each document among its task's documents of that
source; small per-(task, source) sums give every document its place in its queue; pieces are
computed inside tasks, for all documents of a slice at once.  A source with at least 1 / ``max_queues``
of all tokens has its own queue, so there are at most ``max_queues`` of these, whose sizes tasks hold in
memory.  All smaller sources, however many, share a last queue, which is dealt by the same rule in rounds of
its own: its runs get their place in it by a range-partitioned sort over a written table.  A round of it is
``RUN`` tokens per source on average, so that runs do not shrink to single tokens as sources multiply.

With target ``shares`` a named queue earns ``seq_len x share`` a round instead; sources without one
divide what the named leave, by their tokens.  A queue that has run empty earns nothing more, and the
others go on in the proportion of their shares, so every token is packed.

Defined results: null or empty text is the end token alone; null source is a source; null doc_id
and repeated rows are documents of their own; an empty table gives no pieces; other columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from fractions import Fraction
from math import lcm

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltledger.llm import tokens
from voltledger.llm.slices import by_bytes
from voltledger.session import ship_package, stage

SEQ_LEN = 2048
END_ID = 1
MAX_QUEUES = 128
RUN = 32
_BYTES_AT_ONCE = 4 << 20

_TOKENS = "doc_id long, source string, part int, earlier long, n long, ids binary"
_PIECES = ("doc_id long, source string, start long, length long, ids_crc32 long, doc_tokens long, "
           "sequence_id long, offset long")


def _binary(ids: np.ndarray, edges: np.ndarray) -> pa.Array:
    """A binary column whose value i is ids[edges[i]:edges[i + 1]]."""
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer((4 * edges).astype(np.int32)), pa.py_buffer(ids)])


def _tokenize(path: str, end_id: int, added: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.word_encoder(path, added)
        part, sent = TaskContext.get().partitionId(), {}
        for batch in batches:
            texts, sources = batch.column("text").to_pylist(), batch.column("source").to_pylist()
            start = 0
            while start < len(texts):  # slices of bounded size
                stop, size = start, 0
                while stop < len(texts) and (stop == start or size < _BYTES_AT_ONCE):
                    size += len(texts[stop] or "")
                    stop += 1
                ids, counts = encoder.flat([t or "" for t in texts[start:stop]])
                edges = np.concatenate([[0], np.cumsum(counts + 1)])
                closed = np.full(edges[-1], end_id, dtype="<u4")  # the last id of every document stays
                closed[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
                counts, earlier = counts + 1, []
                for source, n in zip(sources[start:stop], counts.tolist(), strict=True):
                    earlier.append(sent.get(source, 0))
                    sent[source] = earlier[-1] + n
                n = stop - start
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(start, n), batch.column("source").slice(start, n),
                    pa.array(np.full(n, part, dtype=np.int32)), pa.array(earlier, pa.int64()),
                    pa.array(counts, pa.int64()), _binary(closed, edges),
                ], names=["doc_id", "source", "part", "earlier", "n", "ids"])
                start = stop

    return run


def muldiv(a, b, c) -> tuple[np.ndarray, np.ndarray]:
    """Quotient and remainder of a * b / c for whole numbers, exact although a * b may pass 64 bits.

    c must be below 2 ** 60 and the quotient below 2 ** 50: a float is then off by one at most, and the
    remainder, small itself, comes out right modulo 2 ** 64.
    """
    a, b, c = (np.asarray(x, dtype=np.int64) for x in (a, b, c))
    q = np.floor(a.astype(float) * b / c).astype(np.int64)
    with np.errstate(over="ignore"):
        rest = a * b - q * c
    more = np.floor_divide(rest, c)
    return q + more, rest - more * c


def _spread(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, first[i] + 0 .. count[i] - 1) for every i."""
    row = np.repeat(np.arange(len(count)), count)
    return row, first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)


class Rounds:
    """Where tokens of a queue stand in the round-robin stream."""

    _CELLS = 1 << 20

    def __init__(self, sizes: list[int], seq_len: int, weights: list[int] | None = None):
        self.sizes, self.total, self.seq_len = np.array([int(x) for x in sizes], dtype=np.int64), int(sum(sizes)), seq_len
        whole = sum(weights or sizes)
        # Within what `muldiv` takes; rounds of a queue run with the same numbers everywhere.
        most = (1 << 59) // seq_len
        scaled = [int(w) if whole <= most else max(1, int(w) * most // whole) if w else 0 for w in weights or sizes]
        self.weights, self.whole = np.array(scaled, dtype=np.int64), max(1, sum(scaled))
        tail, held, self._tail = self.total % seq_len, 0, [0]
        while held < tail:
            held += 1 << ((tail - held).bit_length() - 1)
            self._tail.append(held)
        self._tail = np.array(self._tail, dtype=np.int64)

    def sent(self, queue, r) -> np.ndarray:
        """Tokens that ``queue`` has sent before round r."""
        return np.minimum(self.sizes[queue], muldiv(self.weights[queue] * self.seq_len, r, self.whole)[0])

    def round_of(self, queue, at) -> np.ndarray:
        """The round in which ``queue`` sends its token ``at``: the last r with sent(r) <= at."""
        # sent(r) <= at  <=>  weight * seq_len * r < (at + 1) * whole
        q, rest = muldiv(np.asarray(at) + 1, self.whole, self.weights[queue] * self.seq_len)
        return q - (rest == 0)

    def _starts(self, queue: np.ndarray, r: np.ndarray) -> np.ndarray:
        """Per (queue, round) the place in the stream where that queue's run of that round starts."""
        rounds, at = np.unique(r, return_inverse=True)
        out, every = np.empty(len(r), dtype=np.int64), np.arange(len(self.sizes))
        step = max(1, self._CELLS // len(every))
        order = np.argsort(at, kind="stable")
        edges = np.searchsorted(at[order], np.arange(0, len(rounds) + step, step))
        for i, start in enumerate(range(0, len(rounds), step)):
            held = rounds[start : start + step, None]
            before, after = self.sent(every, held), self.sent(every, held + 1)
            runs = np.cumsum(after - before, axis=1) - (after - before)
            rows = order[edges[i] : edges[i + 1]]
            out[rows] = (before.sum(1)[:, None] + runs)[at[rows] - start, queue[rows]]
        return out

    def spans(self, queue: np.ndarray, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(i, place in the stream, length) of the runs that tokens at[i] .. at[i] + n[i] - 1 of queue[i] form."""
        first = self.round_of(queue, at)
        row, r = _spread(first, self.round_of(queue, at + n - 1) - first + 1)
        q = queue[row]
        before = self.sent(q, r)
        start, stop = np.maximum(at[row], before), np.minimum((at + n)[row], self.sent(q, r + 1))
        some = stop > start
        row, q, r, start, stop, before = (x[some] for x in (row, q, r, start, stop, before))
        return row, self._starts(q, r) + start - before, stop - start

    def runs(self, queue: int, at: int, n: int) -> Iterator[tuple[int, int]]:
        """The spans of one document."""
        _, place, length = self.spans(*(np.array([x], dtype=np.int64) for x in (queue, at, n)))
        return zip(place.tolist(), length.tolist(), strict=True)

    def _sequence(self, place: np.ndarray) -> np.ndarray:
        full = self.total // self.seq_len
        in_tail = np.searchsorted(self._tail, place - full * self.seq_len, side="right") - 1
        return np.where(place < full * self.seq_len, place // self.seq_len, full + in_tail)

    def _start(self, sequence: np.ndarray) -> np.ndarray:
        full = self.total // self.seq_len
        in_tail = self._tail[np.clip(sequence - full, 0, len(self._tail) - 1)]
        return np.where(sequence < full, sequence * self.seq_len, full * self.seq_len + in_tail)

    def cut(self, place: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, ...]:
        """(i, sequence, offset in it, length) of the pieces of stretches of the stream, in their order."""
        first = self._sequence(place)
        row, sequence = _spread(first, self._sequence(place + length - 1) - first + 1)
        base = self._start(sequence)
        start, stop = np.maximum(place[row], base), np.minimum((place + length)[row], self._start(sequence + 1))
        return row, sequence, start - base, stop - start


def _place(rounds: Rounds):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "source", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        for whole in batches:
            for a, b in by_bytes(whole.column("ids")):
                batch = whole.slice(a, b - a)
                ids = batch.column("ids").cast(pa.large_binary())
                edges = np.frombuffer(ids.buffers()[1], dtype=np.int64)[ids.offset : ids.offset + len(ids) + 1]
                queue, before, skip, n = (batch.column(c).to_numpy().astype(np.int64) for c in ("queue", "before", "skip", "n"))
                doc, place, length = rounds.spans(queue, before, np.diff(edges) // 4)
                run, sequence, offset, take = rounds.cut(place, length)
                doc = doc[run]
                # Pieces follow one another, so tokens before a piece are sums of lengths.
                done = np.cumsum(take) - take
                done -= (edges[doc] - edges[0]) // 4
                starts = edges[doc] + 4 * done
                view, at = memoryview(ids.buffers()[2]), pa.array(doc)
                crc = [zlib.crc32(view[i:j]) for i, j in zip(starts.tolist(), (starts + 4 * take).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(at), batch.column("source").take(at), pa.array(skip[doc] + done), pa.array(take),
                     pa.array(crc, pa.int64()), pa.array(n[doc]), pa.array(sequence), pa.array(offset)], names=names)

    return run


_RUNS = "r long, source string, before long, doc_id long, skip long, n long, ids binary"
_SORTED = "p int, start long, doc_id long, source string, skip long, n long, ids binary"


def _shared_runs(total: int, round_len: int):
    """The runs that documents of the shared queue form in its own rounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["r", "source", "before", "doc_id", "skip", "n", "ids"]
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        out: list[tuple] = []
        for batch in batches:
            for doc_id, source, size, at, n, ids in zip(
                    *(batch.column(c).to_pylist() for c in ("doc_id", "source", "size", "before", "n", "ids")), strict=True):
                done = 0
                while done < n:
                    r = ((at + done + 1) * total - 1) // (size * round_len)
                    stop = min(n, size * round_len * (r + 1) // total - at)
                    out.append((r, source, at + done, doc_id, done, n, ids[4 * done : 4 * stop]))
                    done = stop
                if len(out) >= 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return run


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per run the tokens before it in its partition."""
    part, done = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = np.array([len(x) // 4 for x in batch.column("ids").to_pylist()], dtype=np.int64)
        starts = done + np.cumsum(n) - n
        done += int(n.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array([part] * len(n), pa.int32()), pa.array(starts), *(batch.column(c) for c in ("doc_id", "source", "skip", "n", "ids"))],
            names=["p", "start", "doc_id", "source", "skip", "n", "ids"])


def _shared_queue(docs: DataFrame, total: int, round_len: int, queue: int) -> DataFrame:
    """Runs of the sources without a queue of their own, with their place in the queue they share."""
    order = [F.asc_nulls_first(c) for c in ("r", "source", "before")]
    runs = stage(docs.mapInArrow(_shared_runs(total, round_len), _RUNS), "shared-runs")
    placed = stage(runs.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_number, _SORTED), "shared-order")
    # One number per partition of the sort.
    sums = {r["p"]: r["n"] for r in placed.groupBy("p").agg(F.sum(F.length("ids") / 4).cast("long").alias("n")).collect()}
    bases, done = [], 0
    for p in sorted(sums):
        bases.append((p, done))
        done += sums[p]
    first = F.broadcast(docs.sparkSession.createDataFrame(bases, "p int, base long"))
    return placed.join(first, "p").select("doc_id", "source", F.lit(queue).alias("queue"), (F.col("start") + F.col("base")).alias("before"),
                                          "skip", "n", "ids")


def _weights(sources: list[str | None], sizes: list[int], shares: dict[str | None, float]) -> list[int]:
    """Whole numbers in the proportion of the targets; sizes beyond the sources are of the queue they share."""
    exact = {k: Fraction(v).limit_denominator(10**9) for k, v in shares.items()}
    free = sum(n for i, n in enumerate(sizes) if i >= len(sources) or sources[i] not in exact)
    left = 1 - sum(exact.values())
    if min(exact.values()) <= 0 or left < 0 or (free and not left):
        raise ValueError("shares must be above 0, sum to at most 1 and leave something to sources that are not named")
    found = [exact[sources[i]] if i < len(sources) and sources[i] in exact else left * n / free for i, n in enumerate(sizes)]
    scale = lcm(*(x.denominator for x in found))
    return [int(x * scale) for x in found]


def pack(docs: DataFrame, tokenizer: str | None = None, seq_len: int = SEQ_LEN, end_id: int = END_ID,
         max_queues: int = MAX_QUEUES, added_tokens: bool = False,
         shares: dict[str | None, float] | None = None) -> DataFrame:
    """One row per piece of a document: where its tokens stand in the packed sequences.

    With ``added_tokens`` ids are those of the tokenizer file with add_special_tokens=False and nothing
    else: the strings of its added tokens in a text become their ids.  Without, they are ordinary text.
    ``shares`` are target shares of sources (at most ``max_queues``); without, each has its share of all tokens.
    """
    shares = shares or {}
    if len(shares) > max_queues:
        raise ValueError("more shares than queues")
    spark = docs.sparkSession
    ship_package(spark)
    path = tokenizer or tokens.tokenizer_path(tokens.WORD_VOCAB)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                         F.col("text").cast("string").alias("text"))
    coded = stage(narrow.mapInArrow(_tokenize(path, end_id, added_tokens), _TOKENS), "tokens")

    by_task = stage(coded.groupBy("source", "part").agg(F.sum("n").alias("n")), "token-sums")
    by_source = by_task.groupBy("source").agg(F.sum("n").alias("n"))
    total, sources = by_source.agg(F.sum("n"), F.count("*")).first()
    if not total:
        return spark.createDataFrame([], _PIECES)
    named = F.col("source").isin([k for k in shares if k is not None])
    named = F.coalesce(named, F.lit(None in shares)) if shares else F.lit(False)
    # At most max_queues rows can have such a share of all tokens, plus the named ones.
    own = by_source.where(named | (F.col("n") * max_queues >= total))
    largest = own.orderBy(named.desc(), F.desc("n"), F.asc_nulls_first("source")).collect()
    sizes = [r["n"] for r in largest]
    rest = total - sum(sizes)
    round_len = max(seq_len, RUN * (sources - len(largest)))
    queues = F.broadcast(spark.createDataFrame(
        [(r["source"], i) for i, r in enumerate(largest)], "source string, queue int"))
    sizes += [rest] * (rest > 0)
    rounds = Rounds(sizes, seq_len, _weights([r["source"] for r in largest], sizes, shares) if shares else None)

    same = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))
    # A source's order: task, row.  One row per task and source here.
    base = by_task.alias("a").join(queues.alias("q"), same("a", "q"), "left").select("a.*", "q.queue")
    every = Window.partitionBy("source")
    earlier = every.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = stage(base.select("source", "part", "queue", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"),
                             F.sum("n").over(every).alias("size")), "queue-places")

    joined = coded.alias("a").join(base.alias("b"), same("a", "b") & (F.col("a.part") == F.col("b.part"))).select(
        "a.doc_id", "a.source", "b.queue", (F.col("a.earlier") + F.col("b.base")).alias("before"), "b.size",
        F.lit(0).cast("long").alias("skip"), "a.n", "a.ids")
    apart = joined.where("queue IS NOT NULL") if rest else joined
    placed = apart.drop("size").mapInArrow(_place(rounds), _PIECES)
    if rest:
        shared = _shared_queue(joined.where("queue IS NULL"), rest, round_len, len(largest))
        placed = placed.unionByName(shared.mapInArrow(_place(rounds), _PIECES))
    return placed
