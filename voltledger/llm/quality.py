"""Quality by a generalised additive model with pairwise interactions.

A text becomes a dozen numbers (shares of symbols, capitals, repeated words, ...).  Every number is
binned; boosting goes round the features in turn and fits a tree of three leaves on the bins of
one feature to the current gradient, which adds up to one lookup table per feature.  Then the
pairs that explain most of what is left get two-dimensional tables by the same boosting.  A score
is the sum of table entries, added for whole batches at once.

The model is fitted on at most ``sample_size`` labelled documents (those with the smallest id
hashes); twelve numbers of each come to the driver.  Its tables are a few thousand numbers.

Defined results: null and empty texts have zero for every number and are scored like others; null
doc_id is never held out; repeated rows are scored each; without labels every score is 0.5; other
columns are passed on where the caller asks for them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltledger.llm import samples, texts
from voltledger.session import ship_package

SAMPLE_SIZE = 20_000
FEATURES = ("log_chars", "symbols", "capitals", "digits", "blanks", "word_length", "long_words", "distinct_words",
            "doubled_words", "repeated_grams", "top_symbol", "line_length", "repeated_lines", "symbol_runs")

_KIND = np.zeros(256, dtype=np.uint8)  # 0 other letters, 1 blank, 2 digit, 3 capital, 4 symbol, 5 plain punctuation
for _c in range(128):
    _ch = chr(_c)
    _KIND[_c] = (1 if _ch.isspace() or _c < 32 else 2 if _ch.isdigit() else 3 if _ch.isupper() else 0 if _ch.islower()
                 else 5 if _ch in ".,;:'\"-?()" else 4)


def text_numbers(text: str | None) -> np.ndarray:
    """The feature values of a whole text."""
    out = np.zeros(len(FEATURES))
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if not len(raw):
        return out
    n = len(raw)
    kind = _KIND[raw]
    counts = np.bincount(kind, minlength=6)
    letters = max(1, counts[0] + counts[3])
    symbol = kind == 4
    out[:5] = np.log1p(n), counts[4] / n, counts[3] / letters, counts[2] / n, counts[1] / n
    (words,) = texts.word_hashes(text)
    if len(words):
        out[5] = letters / len(words)
        ordered = np.sort(words)
        out[7] = (1 + np.count_nonzero(ordered[1:] != ordered[:-1])) / len(words)
        out[8] = np.count_nonzero(words[1:] == words[:-1]) / len(words)
        if len(words) > 3:
            grams = len(words) - 2
            out[9] = 1 - len(texts.shingle_set(words, 3)) / grams
    out[6] = np.count_nonzero(np.diff(np.flatnonzero(kind == 1), prepend=-1, append=n) > 21) / max(1, len(words))
    out[10] = np.bincount(raw[symbol], minlength=1).max() / n if symbol.any() else 0.0
    lines = (text or "").split("\n")
    out[11] = np.log1p(n / len(lines))
    out[12] = 1 - len(set(lines)) / len(lines)
    out[13] = np.count_nonzero(symbol[1:] & symbol[:-1]) / n
    return out


@dataclass
class AdditiveModel:
    """Lookup tables per feature and per pair, on the log-odds scale."""

    intercept: float
    edges: list[np.ndarray]
    main: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for f, (edges, values) in enumerate(zip(self.edges, self.main, strict=True)):
            total += values[np.searchsorted(edges, x[:, f], side="right")]
        for a, b, ea, eb, values in self.pairs:
            total += values[np.searchsorted(ea, x[:, a], side="right"), np.searchsorted(eb, x[:, b], side="right")]
        return texts.sigmoid(total)


_SMOOTH = 1.0  # added to every leaf's weight


def _gain(g, h):
    return g * g / (h + _SMOOTH)


def _best_cut(g: np.ndarray, h: np.ndarray, lo: int, hi: int) -> tuple[float, int]:
    """The best place to cut bins lo..hi-1, and what it gains."""
    gl, hl = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
    if not len(gl):
        return 0.0, lo
    gs, hs = g[lo:hi].sum(), h[lo:hi].sum()
    gains = _gain(gl, hl) + _gain(gs - gl, hs - hl) - _gain(gs, hs)
    k = int(np.argmax(gains))
    return float(gains[k]), lo + k + 1


def _line_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Step values of a three-leaf tree over the bins of one feature."""
    n = len(g)
    _, cut = _best_cut(g, h, 0, n)
    left, right = _best_cut(g, h, 0, cut), _best_cut(g, h, cut, n)
    cuts = sorted({0, cut, (left if left[0] >= right[0] else right)[1], n})
    out = np.zeros(n)
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + _SMOOTH)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, int, int]:
    """The best cross cut of a grid of bins, and its gain over no cut."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    tg, th = cg[-1, -1], ch[-1, -1]
    top, left = (cg[:-1, -1:], ch[:-1, -1:]), (cg[-1:, :-1], ch[-1:, :-1])
    a, ah = cg[:-1, :-1], ch[:-1, :-1]
    gains = (_gain(a, ah) + _gain(top[0] - a, top[1] - ah) + _gain(left[0] - a, left[1] - ah)
             + _gain(tg - top[0] - left[0] + a, th - top[1] - left[1] + ah) - _gain(tg, th))
    i, j = np.unravel_index(int(np.argmax(gains)), gains.shape)
    return float(gains[i, j]), int(i) + 1, int(j) + 1


def _grid(ba, bb, shape, v):
    return np.bincount(ba * shape[1] + bb, weights=v, minlength=shape[0] * shape[1]).reshape(shape)


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.15, bins: int = 64, pair_bins: int = 12,
        n_pairs: int = 8, pair_rounds: int = 60) -> AdditiveModel:
    n_features = x.shape[1]
    if not len(y):
        return AdditiveModel(0.0, [np.empty(0)] * n_features, [np.zeros(1)] * n_features)
    share = np.clip(y.mean(), 0.5 / len(y), 1 - 0.5 / len(y))
    model = AdditiveModel(float(np.log(share / (1 - share))), [_edges(x[:, f], bins) for f in range(n_features)], [])
    binned = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model.edges)]
    model.main = [np.zeros(len(e) + 1) for e in model.edges]
    z = np.full(len(y), model.intercept)
    for _ in range(rounds):
        for f, at in enumerate(binned):
            if len(model.main[f]) < 2:
                continue
            p = texts.sigmoid(z)
            g = np.bincount(at, weights=y - p, minlength=len(model.main[f]))
            h = np.bincount(at, weights=p * (1 - p), minlength=len(model.main[f]))
            step = rate * _line_tree(g, h)
            model.main[f] += step
            z += step[at]

    coarse = [_edges(x[:, f], pair_bins) for f in range(n_features)]
    at = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(coarse)]
    p = texts.sigmoid(z)
    found = []
    for a, b in combinations([f for f in range(n_features) if len(coarse[f])], 2):
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        found.append((_quadrants(_grid(at[a], at[b], shape, y - p), _grid(at[a], at[b], shape, p * (1 - p)))[0], a, b))
    chosen = [(a, b) for _, a, b in sorted(found, reverse=True)[:n_pairs]]
    tables = {ab: np.zeros((len(coarse[ab[0]]) + 1, len(coarse[ab[1]]) + 1)) for ab in chosen}
    for _ in range(pair_rounds):
        for (a, b), values in tables.items():
            p = texts.sigmoid(z)
            g, h = (_grid(at[a], at[b], values.shape, v) for v in (y - p, p * (1 - p)))
            _, i, j = _quadrants(g, h)
            step = np.zeros(values.shape)
            for rows in (slice(0, i), slice(i, None)):
                for cols in (slice(0, j), slice(j, None)):
                    step[rows, cols] = rate * g[rows, cols].sum() / (h[rows, cols].sum() + _SMOOTH)
            values += step
            z += step[at[a], at[b]]
    model.pairs = [(a, b, coarse[a], coarse[b], values) for (a, b), values in tables.items()]
    return model


def _numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [text_numbers(t.as_py()).tobytes() for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), pa.array(rows, pa.binary())], names=["doc_id", "label", "numbers"])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 3, held_out: int = 1,
          sample_size: int = SAMPLE_SIZE) -> AdditiveModel:
    ship_package(docs.sparkSession)
    sample = samples.smallest_by_hash(samples.labelled(labels, label, folds, held_out), sample_size)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(sample, "doc_id")
    numbers = rows.select("doc_id", "label", "text").mapInArrow(_numbers, "doc_id long, label int, numbers binary")
    # One row per document of the sample, whatever is repeated.
    fitted = numbers.groupBy("doc_id").agg(F.min("numbers").alias("numbers"), F.max("label").alias("label"))
    table = fitted.orderBy("doc_id").toArrow()
    x = np.array([np.frombuffer(v, dtype=float) for v in table.column("numbers").to_pylist()]).reshape(-1, len(FEATURES))
    return fit(x, np.array(table.column("label").to_pylist(), dtype=float))


def score(docs: DataFrame, model: AdditiveModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and ``quality_score``, one row per document row."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*[F.col(c) for c in keep], F.col("text").cast("string").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([text_numbers(t.as_py()) for t in batch.column("_text")]).reshape(-1, len(FEATURES))
            kept = [c for c in batch.schema.names if c != "_text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(shared.value.score(x))], names=[*kept, "quality_score"])

    return rows.mapInArrow(run, f"{schema}, quality_score double")


def accepted(docs: DataFrame, model: AdditiveModel, least: float = 0.5) -> DataFrame:
    """The documents that score at least ``least``, columns unchanged."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([text_numbers(t.as_py()) for t in batch.column("text")]).reshape(-1, len(FEATURES))
            yield batch.filter(pa.array(shared.value.score(x) >= least))

    return docs.mapInArrow(run, docs.schema)
