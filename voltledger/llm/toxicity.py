"""Toxicity by a factorization machine over hashed terms.

    score = sigmoid(b + sum w_t + sum over pairs of terms <v_t, v_u>)

over the distinct terms of a text.  The pairwise part learns combinations, such as an insult next
to a mention of a group, that adding weights alone misses.  It costs no more than the linear part:
the sum over pairs is half of (sum v)^2 - sum v^2.

Terms are hashes of words and of word starts, folded into ``buckets`` (a power of two).  Two kinds take part: terms
whose presence goes with the label in the fitting sample (z-score of ``min_z`` or more), and terms of a pair whose
presence together moves the label otherwise than each does alone (``min_pair_z``; in a pair such as "one of the two
words but not the other" neither word goes with the label).  Pairs are tested among ``PAIR_TERMS`` terms: the most
telling ones and those nearest to being in half of the documents, where a pair has enough documents on all four sides.
Other terms are left out, so a long text does not gather noise.

The model is fitted on at most ``sample_size`` labelled documents (those with the smallest id hashes).  Terms and
pairs are counted in tasks; what comes to the driver are at most ``max_terms`` + ``PAIR_TERMS`` terms and, of each
fitting document, those among them (at worst 4 bytes x sample x terms, 410 MB; measured far below that).

Defined results: a null or empty text has no terms and scores the intercept; null doc_id is in no
fold; repeated rows are scored each; without labels every score is 0.5; other columns are passed
on where the caller asks for them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltledger.llm import samples, texts
from voltledger.llm.slices import by_bytes
from voltledger.session import ship_package, stage

SAMPLE_SIZE = 20_000
BUCKETS = 1 << 20
MAX_TERMS = 4096
RANK = 8
# Bytes of a word's start that are terms as well.
STARTS = (4, 5, 6, 7)
# Terms whose pairs are tested, the tasks that count them (two whole tables of pairs each), and the documents
# that must be on each of the four sides of a pair.
PAIR_TERMS = 1024
PAIR_TASKS = 4
PAIR_SIDE = 8
PAIR_ROWS = 256
# Terms whose factors are gathered at once; a document with more is a portion of its own.
SCORE_TERMS = 1 << 16


def terms(text: str | None, buckets: int = BUCKETS) -> np.ndarray:
    """The distinct hashed terms of a whole text: its words and their first bytes.

    Word starts let the model know inflected forms that the fitting sample has not seen.
    """
    found = texts.word_hashes(text, *STARTS)
    every = np.concatenate([x * np.uint64(2 * k + 1) for k, x in zip((0, *STARTS), found, strict=True)])
    return np.unique(every >> np.uint64(64 - buckets.bit_length() + 1)).astype(np.int32)


@dataclass
class FactorizationMachine:
    buckets: int
    bias: float
    row_of: np.ndarray  # bucket -> row of the tables, 0 for terms that take no part
    linear: np.ndarray
    factors: np.ndarray

    def score(self, docs: list[np.ndarray]) -> np.ndarray:
        """Scores of documents given as their distinct terms; factors are gathered for some ``SCORE_TERMS`` terms at once."""
        lengths = np.array([len(d) for d in docs], dtype=np.int64)
        upto, out, start = np.cumsum(lengths), np.empty(len(docs)), 0
        while start < len(docs):
            done = upto[start - 1] if start else 0
            stop = max(int(np.searchsorted(upto, done + SCORE_TERMS, side="right")), start + 1)
            rows = np.concatenate([self.row_of[d] for d in docs[start:stop]])
            out[start:stop] = texts.sigmoid(_raw(self, rows, lengths[start:stop])[0])
            start = stop
        return out


def _sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches of rows; an empty stretch sums to 0."""
    out = np.zeros((len(lengths), *values.shape[1:]))
    some = lengths > 0
    if some.any():
        out[some] = np.add.reduceat(values, (np.cumsum(lengths) - lengths)[some], axis=0)
    return out


def _raw(m, rows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    v = m.factors[rows]
    s = _sums(v, lengths)
    pairs = 0.5 * ((s * s).sum(1) - _sums((v * v).sum(1), lengths))
    return m.bias + _sums(m.linear[rows], lengths) + pairs, s


def fit(docs: list[np.ndarray], y: np.ndarray, chosen: np.ndarray, buckets: int = BUCKETS, rank: int = RANK,
        epochs: int = 30, batch: int = 256, rate: float = 0.3, decay: float = 1e-4, seed: int = 7) -> FactorizationMachine:
    """Adagrad on the logistic loss over the chosen terms; the same rows and seed give the same model."""
    share = np.clip(y.mean(), 0.5 / len(y), 1 - 0.5 / len(y)) if len(y) else 0.5
    row_of = np.zeros(buckets, dtype=np.int32)
    row_of[chosen] = np.arange(1, len(chosen) + 1)
    rng = np.random.default_rng(seed)
    m = FactorizationMachine(buckets, float(np.log(share / (1 - share))), row_of, np.zeros(len(chosen) + 1),
                             rng.normal(0, 0.05, (len(chosen) + 1, rank)))
    m.factors[0] = 0
    seen = [(lambda r: r[r > 0])(row_of[d]) for d in docs]
    gw, gv, gb = np.full_like(m.linear, 1e-8), np.full_like(m.factors, 1e-8), 1e-8
    for _ in range(epochs if len(chosen) else 0):
        order = rng.permutation(len(y))
        for start in range(0, len(order), batch):
            part = order[start : start + batch]
            lengths = np.array([len(seen[i]) for i in part], dtype=np.int64)
            rows = np.concatenate([seen[i] for i in part])
            z, s = _raw(m, rows, lengths)
            error = texts.sigmoid(z) - y[part]
            e = np.repeat(error, lengths)
            v = m.factors[rows]
            dw = np.bincount(rows, weights=e, minlength=len(m.linear)) / len(part)
            dv = np.zeros_like(m.factors)
            np.add.at(dv, rows, e[:, None] * (np.repeat(s, lengths, axis=0) - v))
            dv /= len(part)
            used = np.unique(rows)
            dw[used] += decay * m.linear[used]
            dv[used] += decay * m.factors[used]
            gb += (db := error.mean()) ** 2
            gw[used] += dw[used] ** 2
            gv[used] += dv[used] ** 2
            m.bias -= rate * db / np.sqrt(gb)
            m.linear[used] -= rate * dw[used] / np.sqrt(gw[used])
            m.factors[used] -= rate * dv[used] / np.sqrt(gv[used])
    return m


def _terms_of(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in by_bytes(batch.column("text")):
                part = batch.slice(start, stop - start)
                rows = [terms(t.as_py(), buckets).tobytes() for t in part.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("label"), pa.array(rows, pa.binary())], names=["doc_id", "label", "terms"])

    return run


def _count_terms(buckets: int):
    """Per task: how many of its documents hold each term, and how many of those are labelled 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, hits = np.zeros(buckets, dtype=np.int64), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for row, label in zip(batch.column("terms"), batch.column("label").to_pylist(), strict=True):
                found = np.frombuffer(row.as_py(), dtype=np.int32)
                n[found] += 1
                if label:
                    hits[found] += 1
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[some]), pa.array(hits[some])], names=["term", "n", "hits"])

    return run


def _counts(coded: DataFrame, buckets: int) -> tuple[DataFrame, int, int]:
    """(term, n, hits) of the sample, its documents and those labelled 1."""
    total, ones = coded.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    counts = coded.select("terms", "label").mapInArrow(_count_terms(buckets), "term int, n long, hits long")
    return stage(counts.groupBy("term").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")), "sample-counts"), total, ones


def _rows(df: DataFrame) -> np.ndarray:
    return np.array([tuple(r) for r in df.select("term", "n", "hits").collect()], dtype=np.int64).reshape(-1, 3)


def telling_terms(counts: DataFrame, total: int, ones: int, min_docs: int, min_z: float, max_terms: int) -> np.ndarray:
    """(term, n, hits) of terms that go with the label: two-proportion z-score, strongest first, max_terms at most."""
    p = ones / max(total, 1)
    z = F.abs((F.col("hits") - F.col("n") * p) / F.sqrt(F.greatest(F.col("n") * (p * (1 - p)), F.lit(1e-9))))
    kept = counts.withColumn("z", z).where((F.col("n") >= min_docs) & (F.col("z") >= min_z))
    return _rows(kept.orderBy(F.desc("z"), "term").limit(max_terms))


def paired_terms(coded: DataFrame, counts: DataFrame, total: int, ones: int, telling: np.ndarray, buckets: int,
                 min_pair_z: float) -> np.ndarray:
    """Terms of pairs that go with the label beyond what each term does alone.

    With the shares of label 1 on the four sides of a pair (both, one, other, none) the contrast
    both - one - other + none is 0 where the terms add up; it is measured in its own standard errors.
    """
    even = counts.where((F.col("n") >= 2 * PAIR_SIDE) & (F.col("n") <= total - 2 * PAIR_SIDE)).orderBy(
        F.abs(F.col("n") * 2 - total), "term").limit(PAIR_TERMS)
    among = np.concatenate([telling[: PAIR_TERMS // 2], _rows(even)])
    among = among[np.sort(np.unique(among[:, 0], return_index=True)[1])][:PAIR_TERMS]
    if len(among) < 2:
        return np.empty(0, dtype=np.int32)
    place = np.full(buckets, -1, dtype=np.int32)
    place[among[:, 0]] = np.arange(len(among))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, hits = np.zeros((2, len(among), len(among)), dtype=np.float32)  # whole numbers below 2**24
        for batch in batches:
            for start in range(0, batch.num_rows, PAIR_ROWS):
                part = batch.slice(start, PAIR_ROWS)
                x = np.zeros((part.num_rows, len(among)), dtype=np.float32)
                for i, row in enumerate(part.column("terms")):
                    held = place[np.frombuffer(row.as_py(), dtype=np.int32)]
                    x[i, held[held >= 0]] = 1
                both += x.T @ x
                marked = x[np.array(part.column("label").to_pylist()) == 1]
                hits += marked.T @ marked
        for t in np.flatnonzero(both.any(1)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([t], pa.int32()), *(pa.array([a[t, t:].astype(np.int32).tobytes()], pa.binary()) for a in (both, hits))],
                names=["t", "both", "hits"])

    n, s = among[:, 1].astype(float), among[:, 2].astype(float)
    spread = ones / total * (1 - ones / total)

    def judge(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["t"].iloc[0])
        n11, s11 = (np.sum([np.frombuffer(v, dtype=np.int32) for v in pdf[c]], axis=0).astype(float) for c in ("both", "hits"))
        sides = np.stack([n11, n[t] - n11, n[t:] - n11, total - n[t] - n[t:] + n11])
        marked = np.stack([s11, s[t] - s11, s[t:] - s11, ones - s[t] - s[t:] + s11])
        enough = sides.min(0) >= PAIR_SIDE
        sides = np.maximum(sides, 1)
        contrast = np.array([1, -1, -1, 1]) @ (marked / sides)
        z = np.abs(contrast) / np.sqrt(max(spread, 1e-9) * (1 / sides).sum(0))
        found = np.flatnonzero(enough & (z >= min_pair_z))
        return pd.DataFrame({"term": among[np.unique([*(t + found), *([t] if len(found) else [])]).astype(int), 0]}, dtype="int32")

    # Few tasks, whatever the session's width: each sends a table of pairs.
    pairs = coded.select("terms", "label").coalesce(PAIR_TASKS).mapInArrow(count, "t int, both binary, hits binary")
    found = pairs.groupBy("t").applyInPandas(judge, "term int").distinct().orderBy("term")
    return np.array([r["term"] for r in found.collect()], dtype=np.int32)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5, held_out: int = 0,
          sample_size: int = SAMPLE_SIZE, buckets: int = BUCKETS, min_docs: int = 4, min_z: float = 4.0,
          max_terms: int = MAX_TERMS, min_pair_z: float = 8.0) -> FactorizationMachine:
    ship_package(docs.sparkSession)
    sample = samples.smallest_by_hash(samples.labelled(labels, label, folds, held_out), sample_size)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(sample, "doc_id")
    coded = rows.select("doc_id", "label", "text").mapInArrow(_terms_of(buckets), "doc_id long, label int, terms binary")
    # One row per document of the sample, whatever is repeated.
    coded = stage(coded.groupBy("doc_id").agg(F.min("terms").alias("terms"), F.max("label").alias("label")), "sample-terms")
    counts, total, ones = _counts(coded, buckets)
    telling = telling_terms(counts, total, ones, min_docs, min_z, max_terms)
    paired = paired_terms(coded, counts, total, ones, telling, buckets, min_pair_z) if total else np.empty(0, dtype=np.int32)
    single = telling[:, 0].astype(np.int32)
    chosen = np.concatenate([single, np.setdiff1d(paired, single)])
    wanted = np.zeros(buckets, dtype=bool)
    wanted[chosen] = True

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(t.as_py(), dtype=np.int32) for t in batch.column("terms")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array([t[wanted[t]].tobytes() for t in found], pa.binary())],
                names=["doc_id", "label", "terms"])

    table = coded.select("doc_id", "label", "terms").mapInArrow(narrow, "doc_id long, label int, terms binary").toArrow().sort_by("doc_id")
    found = [np.frombuffer(v, dtype=np.int32) for v in table.column("terms").to_pylist()]
    return fit(found, np.array(table.column("label").to_pylist(), dtype=float), chosen, buckets)


def _scores(m: FactorizationMachine, column: pa.Array) -> np.ndarray:
    return m.score([(lambda d: d[m.row_of[d] > 0])(terms(t.as_py(), m.buckets)) for t in column])


def score(docs: DataFrame, model: FactorizationMachine, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and ``toxic_score``, one row per document row."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*[F.col(c) for c in keep], F.col("text").cast("string").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [c for c in batch.schema.names if c != "_text"]
            for start, stop in by_bytes(batch.column("_text")):
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in kept), pa.array(_scores(shared.value, part.column("_text")))],
                    names=[*kept, "toxic_score"])

    return rows.mapInArrow(run, f"{schema}, toxic_score double")


def accepted(docs: DataFrame, model: FactorizationMachine, below: float = 0.5) -> DataFrame:
    """The documents that score below ``below``, columns unchanged."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in by_bytes(batch.column("text")):
                part = batch.slice(start, stop - start)
                yield part.filter(pa.array(_scores(shared.value, part.column("text")) < below))

    return docs.mapInArrow(run, docs.schema)
