"""Benchmark decontamination by winnowing, in native expressions.

A text becomes an array of words (A-Z lowered; a word is a run of digits, a-z and characters above
U+007F).  Hashes of ``GRAM`` consecutive words are taken at every position, and from each
``WINDOW - GRAM + 1`` neighbouring hashes the smallest is kept, the leftmost of equals.  Two texts
that share ``WINDOW`` consecutive words therefore keep the same gram inside that span, at the same
place of it: no shared span of that length is missed.  Kept grams of documents travel with the
words around them and are joined with those of the items; every hit is extended to all windows
that hold it, and those windows are compared with the items' windows as text, so hash collisions
cannot add anything.  Only hits are shuffled: the items' grams are written first, so the planner
knows their size and broadcasts them where they are small, as benchmarks are beside a corpus.

An item of fewer than ``WINDOW`` words is one window of its own length; for each such length that
the benchmark has (nine at most) the grams of that length are taken at every position.

Positions travel inside the hash: the low 30 bits hold the place (a row holds fewer words), the
rest the hash, so the smallest value also decides ties by place.

Defined results: null or wordless text has no words and no hits; null doc_id counts as an id, a null item_id is listed as an empty string; repeated
document rows give equal rows each; an item without words has no window; an empty benchmark finds
nothing; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltledger.session import stage

WINDOW = 10
GRAM = 6
PLACE_BITS = 30

_SPLIT = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words of a text; null has none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _SPLIT), "")


def _shift(a: Column, by: int, length: Column) -> Column:
    return F.slice(a, by + 1, F.greatest(length, F.lit(0)))


def _pairs(a: Column, b: Column, combine) -> Column:
    return F.zip_with(a, b, combine)


def _gram_hashes(df: DataFrame, k: int) -> DataFrame:
    """Adds ``grams``: the hash of words i .. i+k-1 for every i.  Built from blocks of 1, 2, 4, 8 words."""
    df = df.withColumn("_b1", F.transform("words", lambda w: F.xxhash64(w)))
    size, used = 1, 0
    n = F.size("words")
    have: str | None = None
    while size <= k:
        if k & size:
            if have is None:
                df = df.withColumn("_acc", F.col(f"_b{size}"))
            else:
                length = n - (used + size) + 1
                df = df.withColumn("_acc", _pairs(
                    _shift(F.col(have), 0, length), _shift(F.col(f"_b{size}"), used, length),
                    lambda x, y: F.xxhash64(x, y)))
            have, used = "_acc", used + size
        if 2 * size <= k:
            length = n - 2 * size + 1
            df = df.withColumn(f"_b{2 * size}", _pairs(
                _shift(F.col(f"_b{size}"), 0, length), _shift(F.col(f"_b{size}"), size, length),
                lambda x, y: F.xxhash64(x, y)))
        size *= 2
    return df.withColumn("grams", F.col("_acc"))


def _fingerprints(df: DataFrame, k: int, w: int) -> DataFrame:
    """Rows (key columns, fp, start, around): the smallest gram hash of each ``w`` neighbours.

    ``around`` are the words of all windows of ``k + w - 1`` words that hold it, from place ``start`` on.
    """
    keys = [c for c in df.columns if c != "words"]
    df = _gram_hashes(df, k)
    mask, low = ~((1 << PLACE_BITS) - 1), (1 << PLACE_BITS) - 1
    df = df.withColumn("_m", F.transform("grams", lambda g, i: g.bitwiseAND(F.lit(mask)).bitwiseOR(i.cast("long"))))
    # Sliding minimum over w values from minima over 1, 2, 4, ... values.
    span, n = 1, F.size("grams")
    while span < w:
        step = min(span, w - span)
        length = n - (span + step) + 1
        df = df.withColumn("_m", _pairs(
            _shift(F.col("_m"), 0, length), _shift(F.col("_m"), step, length), lambda x, y: F.least(x, y)))
        span += step

    def hit(v: Column) -> Column:
        at = v.bitwiseAND(F.lit(low)).cast("int")
        start = F.greatest(at - (w - 1), F.lit(0))
        return F.struct(
            F.shiftright(v, PLACE_BITS).alias("fp"), start.alias("start"),
            F.array_join(F.slice("words", start + 1, at + (k + w - 1) - start), " ").alias("around"))

    return df.select(*keys, F.explode(F.transform(F.array_distinct("_m"), hit)).alias("_h")).select(*keys, "_h.*")


def _windows(items: DataFrame) -> DataFrame:
    """Distinct windows of the items as text, each with the items that hold it."""
    n = F.size("words")
    length = F.least(n, F.lit(WINDOW))
    texts = F.transform(F.sequence(F.lit(1), n - length + 1), lambda i: F.array_join(F.slice("words", i, length), " "))
    return (
        items.where(n > 0).select("item_id", F.explode(F.array_distinct(texts)).alias("window"))
        .groupBy("window").agg(F.collect_set(F.coalesce(F.col("item_id").cast("string"), F.lit(""))).alias("items"))
    )


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, n_items, items (ids as strings, sorted), contaminated."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"),
                       F.xxhash64(F.col("text").cast("string")).alias("th"))
    items = stage(benchmark.select("item_id", words(F.col("text")).alias("words")), "bench-items")
    windows = stage(_windows(items), "bench-windows")
    n_item = F.size("words")
    # Lengths below WINDOW: nine numbers at most.
    short = sorted(r[0] for r in items.where((n_item > 0) & (n_item < WINDOW)).select(n_item).distinct().collect())
    specs = [(GRAM, WINDOW - GRAM + 1, WINDOW)] + [(n, 1, n) for n in short]

    def hits(k: int, w: int, span: int) -> DataFrame:
        whole = items.where(n_item >= WINDOW) if span == WINDOW else items.where(n_item == span)
        # Written, so that the planner knows its true size when it picks the join.
        known = stage(_fingerprints(whole, k, w).select("fp").distinct(), "bench-prints")
        long_enough = docs.select("doc_id", "th", words(F.col("text")).alias("words")).where(F.size("words") >= span)
        found = _fingerprints(long_enough, k, w).join(known, "fp", "left_semi")
        # Extension: every window of `span` words around the gram.
        near = F.split("around", " ")
        return found.select("doc_id", "th", F.lit(span).alias("span"), F.explode(F.transform(
            F.sequence(F.lit(1), F.size(near) - span + 1),
            lambda i: F.struct((F.col("start") + i - 1).alias("start"), F.array_join(F.slice(near, i, span), " ").alias("window")),
        )).alias("w")).select("doc_id", "th", "span", "w.*")

    shared = reduce(DataFrame.unionByName, [hits(*s) for s in specs]).join(windows, "window")
    covered = F.array_distinct(F.flatten(F.transform(
        F.collect_set(F.struct("start", "span")), lambda s: F.sequence(s["start"], s["start"] + s["span"] - 1))))
    found = shared.groupBy("doc_id", "th").agg(
        F.size(covered).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    counted = docs.select("doc_id", "th", F.size(words(F.col("text"))).cast("long").alias("n_words")).alias("d")
    joined = counted.join(found.alias("f"), F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.th") == F.col("f.th")), "left")
    n_hit = F.coalesce("f.n_hit", F.lit(0).cast("long"))
    items_of = F.coalesce("f.items", F.array().cast("array<string>"))
    return joined.select(
        F.col("d.doc_id").alias("doc_id"), F.col("d.th").alias("text_hash"), F.col("d.n_words").alias("n_words"),
        n_hit.alias("n_hit"), F.size(items_of).cast("long").alias("n_items"), items_of.alias("items"),
        (n_hit > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that share no window with the benchmark, columns unchanged."""
    dirty = stage(contamination(docs, benchmark).where("contaminated").select("doc_id", "text_hash").distinct(), "dirty").alias("x")
    return docs.alias("d").join(
        dirty, F.col("d.doc_id").eqNullSafe(F.col("x.doc_id"))
        & (F.xxhash64(F.col("d.text").cast("string")) == F.col("x.text_hash")), "left_anti")
