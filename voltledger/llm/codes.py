"""Product codes for vectors: Lloyd's algorithm on every part, through anchors-hierarchy metric trees.

Vectors become whole numbers, floor(scale * x), and are cut into equal parts; each part position has a
codebook that starts with that part of the vectors of the smallest ids.  Vectors are dealt into blocks
where they lie, without a shuffle; a block holds its numbers and one metric tree per part (``anchors``)
and is written once.  A round passes the codebooks (parts x entries x width numbers, whatever the corpus)
through the trees of every block and adds up sums and counts per entry: each task sends one row per
entry and component, combined before the shuffle.  The last pass writes codes and errors.

All sums are exact: they travel in limbs of 40 bits, and blocks whose numbers pass 62 bits are held as
Python numbers.  Entries are updated to the sum divided by the count, rounded down.

Defined results: vectors that are null or hold null, NaN or infinite components are dropped; components
missing at the end of shorter vectors, and up to a multiple of the parts, count as zero; rows with
equal vec_id are rows of their own, ordered by vector among the smallest; null ids come last there; fewer
rows than entries give fewer entries; ties go to the lower entry; an entry without parts stays; an
error beyond 64 bits is null in ``error`` (its digits are in ``error_digits``) and makes its label's sum null;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltledger.llm import anchors
from voltledger.llm.hot import hot_keys, join_lookup
from voltledger.session import ship_package, stage

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
BLOCK = 4096
_LIMB = 40
_INT_SAFE = float(1 << 40)
_FIELDS = ("order", "start", "stop", "left", "right", "centre", "radius", "total")
_BLOCKS = f"ids array<long>, label_keys array<int>, vectors binary, wide boolean, rows long, {', '.join(f'{f} array<binary>' for f in _FIELDS)}"


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of finite float64 numbers, exactly; Python numbers where 64 bits may not hold them."""
    if not x.size or np.abs(x).max() * scale < _INT_SAFE:
        return np.floor(x * scale).astype(np.int64)
    exact = np.frompyfunc(lambda v: math.floor(int(v) * scale if abs(v) >= 2.0**53 else v * scale), 1, 1)
    return exact(x).astype(object)


def _pack(x: np.ndarray) -> bytes:
    return ",".join(map(str, x.ravel())).encode() if x.dtype == object else np.ascontiguousarray(x).tobytes()


def _unpack(raw: bytes, shape: tuple, dtype) -> np.ndarray:
    if dtype == object:
        return np.array([int(v) for v in raw.split(b",")] if raw else [], dtype=object).reshape(shape)
    return np.frombuffer(raw, dtype=dtype).reshape(shape)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Components as float64, zeros behind shorter vectors."""
    out = np.zeros((len(column), dims))
    for i, v in enumerate(column):
        v = v.values.to_numpy(zero_copy_only=False)
        out[i, : len(v)] = v
    return out


def _blocks(width: int, parts: int, scale: int, block: int):
    def one(ids: list, labels: list, x: np.ndarray) -> dict:
        v = whole(x, scale)
        trees = [anchors.build(v[:, p * width : (p + 1) * width]) for p in range(parts)]
        return {"ids": ids, "label_keys": labels, "vectors": _pack(v), "wide": v.dtype == object, "rows": len(v)} | {
            f: [_pack(getattr(t, f)) for t in trees] for f in _FIELDS}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("ids", pa.list_(pa.int64())), ("label_keys", pa.list_(pa.int32())), ("vectors", pa.binary()), ("wide", pa.bool_()),
                            ("rows", pa.int64()), *((f, pa.list_(pa.binary())) for f in _FIELDS)])
        ids, labels, held, n = [], [], [], 0
        for batch in batches:
            x = _matrix(batch.column("v"), width * parts)
            ids += batch.column("vec_id").to_pylist()
            labels += batch.column("label_key").to_pylist()
            held.append(x)
            n += len(x)
            while n >= block:
                x = np.concatenate(held)
                yield pa.RecordBatch.from_pylist([one(ids[:block], labels[:block], x[:block])], schema)
                ids, labels, held, n = ids[block:], labels[block:], [x[block:]], n - block
        if n:
            yield pa.RecordBatch.from_pylist([one(ids, labels, np.concatenate(held))], schema)

    return run


def _read(batch: pa.RecordBatch, i: int, width: int, parts: int) -> tuple[np.ndarray, list[anchors.Balls]]:
    """The numbers and the trees of a block."""
    get = lambda name: batch.column(name)[i].as_py()
    kind, n = object if get("wide") else np.int64, get("rows")
    v = _unpack(get("vectors"), (n, width * parts), kind)
    columns = [get(f) for f in _FIELDS]
    types = [np.int64] * 5 + [float, float, kind]
    shapes = [(-1,)] * 5 + [(-1, width), (-1,), (-1, width)]
    return v, [anchors.Balls(*(_unpack(c[p], s, t) for c, s, t in zip(columns, shapes, types, strict=True))) for p in range(parts)]


def limbs(x: int) -> Iterator[int]:
    """x = sum of limb i * 2 ** (40 i); every limb is below 2 ** 40 in size."""
    while not -(1 << _LIMB) < x < 1 << _LIMB:
        yield x & ((1 << _LIMB) - 1)
        x >>= _LIMB
    yield x


def _books(codebooks: list) -> list[np.ndarray]:
    """Codebooks of whole numbers as arrays."""
    most = max((abs(x) for book in codebooks for entry in book for x in entry), default=0)
    return [np.array(book, dtype=np.int64 if most < 1 << 62 else object) for book in codebooks]


def _sums(codebooks: list, width: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = _books(codebooks)
        total = np.zeros((parts, len(books[0]), width + 1), dtype=object)  # last: the count
        for batch in batches:
            for i in range(batch.num_rows):
                v, trees = _read(batch, i, width, parts)
                for p, tree in enumerate(trees):
                    _, sums, counts, _ = anchors.assign(v[:, p * width : (p + 1) * width], tree, books[p])
                    total[p, :, :width] += sums.astype(object)
                    total[p, :, width] += counts.astype(object)
        rows = [(p, e, d, j, x) for p, e, d in np.ndindex(total.shape) if total[p, e, width] for j, x in enumerate(limbs(int(total[p, e, d])))]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int32()] * 4 + [pa.int64()])],
                                             names=["part", "entry", "at", "limb", "x"])

    return run


def _codes(codebooks: list, width: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = _books(codebooks)
        for batch in batches:
            for i in range(batch.num_rows):
                v, trees = _read(batch, i, width, parts)
                error, code = 0, [""] * len(v)
                for p, tree in enumerate(trees):
                    x = v[:, p * width : (p + 1) * width]
                    nearest, *_ = anchors.assign(x, tree, books[p])
                    for e in np.unique(nearest):
                        at = np.flatnonzero(nearest == e)
                        part = np.zeros(len(v), dtype=object)
                        part[at] = anchors.squares(x[at], books[p][e : e + 1])[:, 0]
                        error = error + part
                    code = [c + f"{e:02x}" for c, e in zip(code, nearest.tolist())]
                fits = [int(e) if e < 1 << 63 else None for e in error]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(batch.column("ids")[i].as_py(), pa.int64()), pa.array(batch.column("label_keys")[i].as_py(), pa.int32()),
                     pa.array(code), pa.array(fits, pa.int64()), pa.array([str(e) for e in error])],
                    names=["vec_id", "label_key", "code", "error", "error_digits"])

    return run


def learn(blocks: DataFrame, codebooks: list, width: int, parts: int, rounds: int) -> list:
    """Codebooks after so many rounds."""
    for _ in range(rounds):
        rows = blocks.mapInArrow(_sums(codebooks, width, parts), "part int, entry int, at int, limb int, x long") \
            .groupBy("part", "entry", "at", "limb").agg(F.sum("x").alias("x")).collect()  # parts x entries x (width + 1) x limbs
        found: dict[tuple, int] = {}
        for r in rows:
            key = (r["part"], r["entry"], r["at"])
            found[key] = found.get(key, 0) + (r["x"] << _LIMB * r["limb"])
        codebooks = [[[found[p, e, d] // n for d in range(width)] if (n := found.get((p, e, width))) else entry
                      for e, entry in enumerate(book)] for p, book in enumerate(codebooks)]
    return codebooks


def digest(codebooks: list) -> str:
    """Of all components by part, entry and place."""
    return hashlib.sha256(",".join(str(x) for book in codebooks for entry in book for x in entry).encode()).hexdigest()


def compress(vectors: DataFrame, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             block: int = BLOCK) -> DataFrame:
    """(vec_id, code, error, error_digits, label_error, codebooks_sha256) per kept row of (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    ship_package(spark)
    x = F.col("embedding").cast("array<double>")
    fit = F.col("embedding").isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    kept = vectors.where(F.coalesce(fit, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label_key"), x.alias("v"))
    dims = kept.agg(F.max(F.size("v"))).first()[0]
    if dims is None:
        return spark.createDataFrame(
            [], "vec_id long, code string, error long, error_digits string, label_error long, codebooks_sha256 string")
    width = max(1, -(-dims // parts))
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "v").select("v").limit(entries).toArrow()
    seeds = whole(_matrix(first.column("v").combine_chunks(), width * parts), scale)
    books = [[[int(c) for c in row[p * width : (p + 1) * width]] for row in seeds] for p in range(parts)]

    blocks = stage(kept.mapInArrow(_blocks(width, parts, scale, block), _BLOCKS), "code-blocks")
    books = learn(blocks, books, width, parts, rounds)
    coded = stage(blocks.mapInArrow(
        _codes(books, width, parts), "vec_id long, label_key int, code string, error long, error_digits string"), "codes")
    wide = F.count("*") > F.count("error")
    labels = stage(coded.groupBy("label_key").agg(
        F.count("*").alias("n"),
        F.when(~wide, F.sum(F.col("error").cast("decimal(20,0)")).try_cast("long")).alias("label_error")), "label-errors")
    out = join_lookup(coded, labels.drop("n"), "label_key", hot_keys(labels.select("label_key", "n")))
    return out.drop("label_key").withColumn("codebooks_sha256", F.lit(digest(books)))
