"""Language identification by nearest centroid.

A text becomes counts of hashed byte n-grams (letters lowered, everything else one blank), damped
by a logarithm, weighted by inverse document frequency and scaled to length 1.  Each language has
several centroids, found by spherical k-means among its own texts, because one language can hold
several kinds of text.  A text gets the language of the centroid with the largest cosine; a text
whose cosine is below what nearly all fitting texts of that centroid reach is marked rejected.

Document frequencies are counted over all learning texts, in tasks.  Centroids are fitted on at
most ``per_language`` texts of each language (those with the smallest id hashes), one task per
language; a language's centroids are a few thousand numbers each.

Defined results: null text, or text without a letter, is ``und`` with score 0; null language
is not learned from; null doc_id is not held out; repeated rows are scored each; with nothing to
learn from, everything is ``und``; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltledger.llm import texts
from voltledger.session import ship_package, stage

UNKNOWN = "und"
DIMS = 4096
PER_LANGUAGE = 1500
CENTROIDS = 4
# Share of a centroid's fitting texts that its rejection limit lets go.
REJECT_SHARE = 0.005
# Turns differences of cosines into a probability.
SHARPNESS = 25.0

_LETTER = regex.compile(r"\p{L}")
_FOLD = np.full(256, 32, dtype=np.uint8)
for _c in range(256):
    if 97 <= _c <= 122 or _c >= 128:
        _FOLD[_c] = _c
    elif 65 <= _c <= 90:
        _FOLD[_c] = _c + 32


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def gram_counts(text: str, dims: int = DIMS) -> np.ndarray:
    """Counts of the hashed n-grams of 1 to 3 bytes of a whole text."""
    data = _FOLD[np.frombuffer(f" {text} ".encode("utf-8", "surrogatepass"), dtype=np.uint8)]
    blank = data == 32
    data = data[np.append(True, ~(blank[1:] & blank[:-1]))].astype(np.uint32)
    two = data[:-1] << np.uint32(8) | data[1:]
    three = two[:-1] << np.uint32(8) | data[2:]
    shift = np.uint32(32 - int(dims).bit_length() + 1)
    fold = lambda x, salt: (x + np.uint32(salt)) * np.uint32(0x9E3779B1) >> shift
    counts = np.bincount(fold(two, 1 << 24), minlength=dims)
    counts += np.bincount(fold(data, 2 << 24), minlength=dims)
    counts += np.bincount(fold(three, 3 << 24), minlength=dims)
    return counts


def vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf
    return (v / max(np.sqrt(v @ v), 1e-12)).astype(np.float32)


@dataclass
class Centroids:
    idf: np.ndarray
    languages: list[str]
    of: np.ndarray  # per centroid the place of its language
    centres: np.ndarray
    limits: np.ndarray

    def predict(self, texts_in: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Per text: language, score from 0 to 1, cosine, rejected."""
        n = len(texts_in)
        names, score = [UNKNOWN] * n, np.zeros(n)
        cosine, rejected = np.zeros(n), np.ones(n, dtype=bool)
        for start in range(0, n, 512):
            some = [i for i in range(start, min(n, start + 512)) if self.languages and has_letter(texts_in[i])]
            if not some:
                continue
            cos = np.stack([vector(gram_counts(texts_in[i]), self.idf) for i in some]) @ self.centres.T
            best = np.full((len(some), len(self.languages)), -1.0)
            for k, language in enumerate(self.of):
                np.maximum(best[:, language], cos[:, k], out=best[:, language])
            near = cos.argmax(1)
            odds = np.exp(SHARPNESS * (best - best.max(1, keepdims=True)))
            score[some] = 1.0 / odds.sum(1)
            cosine[some] = cos[np.arange(len(some)), near]
            rejected[some] = cosine[some] < self.limits[near]
            for i, k in zip(some, near, strict=True):
                names[i] = self.languages[self.of[k]]
        return names, score, cosine, rejected


def cluster(x: np.ndarray, k: int, seed: int = 3, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means with far-apart starts: unit centres, and per row its centre."""
    rng = np.random.default_rng(seed)
    centres = x[[int(rng.integers(len(x)))]]
    while len(centres) < min(k, len(x)):
        far = 1 - (x @ centres.T).max(1)
        centres = np.vstack([centres, x[int(far.argmax())]])
    at = np.zeros(len(x), dtype=int)
    for _ in range(rounds):
        at = (x @ centres.T).argmax(1)
        sums = np.stack([x[at == c].sum(0) if (at == c).any() else centres[c] for c in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres.astype(np.float32), (x @ centres.T).argmax(1)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: in how many of its texts each n-gram occurs."""
    found, n = np.zeros(DIMS, dtype=np.int64), 0
    for batch in batches:
        for text in batch.column("text"):
            found += gram_counts(text.as_py()) > 0
            n += 1
    if n:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, DIMS, dtype=np.int32)), pa.array(np.append(n, found))], names=["gram", "n"])


def train(docs: DataFrame, folds: int = 3, held_out: int = 1, per_language: int = PER_LANGUAGE,
          centroids: int = CENTROIDS) -> Centroids:
    ship_package(docs.sparkSession)
    known = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (texts.remainder("doc_id", folds) != held_out))
    rows = known.select("text").mapInArrow(_frequencies, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    counts = {r["gram"]: r["n"] for r in rows.collect()}  # DIMS + 1 rows
    n = counts.get(-1, 0)
    idf = np.log((1 + n) / (1 + np.array([counts.get(g, 0) for g in range(DIMS)], dtype=float))) + 0.05

    # The ids of smallest hash per language.  Counts by hash range tell which ranges can hold them, so that
    # no task meets all ids of a language.
    ids = known.select("lang", "doc_id").distinct().withColumn("h", F.xxhash64("doc_id")).withColumn("range", F.shiftright("h", 52))
    held = ids.groupBy("lang", "range").agg(F.count("*").alias("n"))  # at most 4096 rows a language
    before = Window.partitionBy("lang").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = held.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).where(F.col("before") < per_language)
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    chosen = stage(ids.join(ranges.select("lang", "range"), ["lang", "range"]).withColumn("k", F.row_number().over(order))
                   .where(F.col("k") <= per_language).select("lang", "doc_id"), "fit-sample")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = [t if has_letter(t) else None for t in batch.column("text").to_pylist()]
            rows = [t and vector(gram_counts(t), idf).tobytes() for t in some]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("lang"), pa.array(rows, pa.binary())], names=["doc_id", "lang", "vector"])

    coded = known.join(chosen, ["lang", "doc_id"]).select("doc_id", "lang", "text").mapInArrow(
        vectors, "doc_id long, lang string, vector binary").where("vector IS NOT NULL")
    once = coded.groupBy("lang", "doc_id").agg(F.min("vector").alias("vector"))

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        x = np.stack([np.frombuffer(v, dtype=np.float32) for v in group.sort_values("doc_id")["vector"]])
        centres, at = cluster(x, centroids)
        cos = (x * centres[at]).sum(1)
        limits = [float(np.quantile(cos[at == c], REJECT_SHARE)) if (at == c).any() else -1.0 for c in range(len(centres))]
        return pd.DataFrame({"lang": group["lang"].iloc[0], "centre": [c.tobytes() for c in centres], "limit": limits})

    found = once.groupBy("lang").applyInPandas(fit, "lang string, centre binary, limit double").collect()  # few per language
    found.sort(key=lambda r: (r["lang"], r["centre"]))
    languages = sorted({r["lang"] for r in found})
    return Centroids(
        idf, languages, np.array([languages.index(r["lang"]) for r in found], dtype=int),
        np.array([np.frombuffer(r["centre"], dtype=np.float32) for r in found]).reshape(-1, DIMS),
        np.array([r["limit"] for r in found]))


def identify(docs: DataFrame, model: Centroids) -> DataFrame:
    """doc_id, lang_pred, score, cosine, rejected; one row per document row."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, score, cosine, rejected = shared.value.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score), pa.array(cosine), pa.array(rejected)],
                names=["doc_id", "lang_pred", "score", "cosine", "rejected"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, lang_pred string, score double, cosine double, rejected boolean")
