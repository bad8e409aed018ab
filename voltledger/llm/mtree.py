"""Exact top-k by inner product with M-trees.

Inner product is no metric, so vectors get one more component, sqrt(M^2 - |x|^2) with M the
largest length: then distance to the query (whose extra component is 0) falls exactly as inner
product rises, d^2 = |q|^2 + M^2 - 2 q.x, and the triangle inequality holds.

The index is a forest of M-trees.  At the top stand regions around bounded-many pivots; a region
is cut into shards of about ``SHARD`` vectors, and each shard is one M-tree: pages of routing
objects with covering radii and distances to their parent, leaves of vectors with distances to
theirs.  Pages are rows of a written table.

Every query first searches the shards of the region that can hold the nearest vectors, which gives
it a k-th best.  It then visits only the shards of regions whose radius and pivot distance leave room
for something better, with that k-th best as a limit from the start.  Inside a tree, pages are
taken best first; |d(q, parent) - d(x, parent)| bounds d(q, x) from below, and only entries this
does not rule out are computed.  Distances only rule out (with slack for rounding); scores are
computed in integers.

Queries of a shard are searched in blocks, so neither side of a task grows with the corpus; a shard's
pages are sent to the blocks that ask for it and to no others.

Vectors whose squared length passes 2^60 (``wide``) would leave 64 bits.  They stay outside the trees: wide
queries are compared with all vectors and all queries with wide vectors, in blocks; bounds in float64
leave few candidates, whose scores are computed in Python's unbounded integers.

Defined results: vectors that are null or hold null, NaN or infinite components take no part, nor
do rows without vec_id; missing components of shorter vectors count as zero; rows equal in id and
vector are candidates each, and one query; a query is never paired with rows of its own id; ties go to the
smaller vec_id; scores are ranked exactly and are null in ``score`` where they pass 64 bits; other
columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltledger.session import ship_package, stage

REGIONS = 64
SHARD = 8192
QUERY_BLOCK = 1024
FANOUT, LEAF = 16, 256
# Scores are whole numbers; bounds from distances are widened by this much, and by a share of the squares they
# come from that is far above the rounding of float64.
SLACK, ROUNDING = 0.25, 1e-11
# Squared length up to which a vector is indexed: all its scores then fit 64 bits.
NARROW = float(1 << 60)
ROW_BLOCK, WIDE_QUERIES = 16384, 256


def to_integers(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """(vec_id, v, wide, scale, copies) of the rows that take part: components as floor(scale * x), or as they are if wide."""
    fit = F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    own = F.when(F.coalesce(fit, F.lit(False)), F.transform("embedding", lambda x: x.cast("double")))
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), own.alias("x")).where("vec_id IS NOT NULL AND x IS NOT NULL")
    square = F.aggregate("x", F.lit(0.0), lambda a, x: a + (x * scale) * (x * scale))
    return kept.withColumn("narrow", square < F.lit(NARROW)).select(
        "vec_id", F.when(F.col("narrow"), F.transform("x", lambda x: F.floor(x * scale))).alias("v"),
        F.when(~F.col("narrow"), F.col("x")).alias("wide"), F.lit(scale).alias("scale")
    ).groupBy("vec_id", "v", "wide", "scale").agg(F.count("*").alias("copies"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    out = np.zeros((len(column), dims), dtype=np.int64)
    for i, v in enumerate(column):
        v = v.values.to_numpy()
        out[i, : len(v)] = v
    return out


def lift(v: np.ndarray, top: int) -> np.ndarray:
    """Vectors with the component that makes inner product a distance."""
    rest = np.maximum(float(top) - (v * v).sum(1).astype(float), 0.0)
    return np.hstack([v.astype(float), np.sqrt(rest)[:, None]])


def _distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(((x - p) ** 2).sum(-1), 0.0))


_PAGES = ("region int, shard int, page int, leaf boolean, ids array<long>, copies array<long>, vectors binary, radii array<double>, "
          "parents array<double>")


class Builder:
    """One M-tree, from its root down: page 0 is the root."""

    def __init__(self, ids: np.ndarray, v: np.ndarray, top: int, copies: np.ndarray | None = None):
        self.ids, self.v, self.x = ids, v, lift(v, top)
        self.copies = np.ones(len(ids), dtype=np.int64) if copies is None else copies
        self.pages: list[dict] = []
        self._least: dict[int, int] = {}
        self._add(np.arange(len(ids)), None)

    def _add(self, at: np.ndarray, parent: np.ndarray | None) -> int:
        page = len(self.pages)
        self.pages.append({})
        to_parent = lambda x: np.zeros(len(x)) if parent is None else _distances(x, parent)
        if len(at) <= LEAF:
            at = at[np.argsort(self.ids[at], kind="stable")]
            self.pages[page] = {"page": page, "leaf": True, "ids": self.ids[at], "copies": self.copies[at], "vectors": self.v[at].tobytes(),
                                "radii": np.empty(0), "parents": to_parent(self.x[at])}
            return page
        routes, parts = self._split(at)
        children = [self._add(part, self.x[r]) for r, part in zip(routes, parts, strict=True)]
        radii = [_distances(self.x[part], self.x[r]).max() for r, part in zip(routes, parts, strict=True)]
        # The smallest id below a child settles ties without opening it.
        self.pages[page] = {"page": page, "leaf": False,
                            "ids": np.array([[c, self.ids[p].min()] for c, p in zip(children, parts, strict=True)]).ravel(),
                            "copies": np.empty(0, dtype=np.int64), "vectors": self.x[routes].tobytes(), "radii": np.array(radii), "parents": to_parent(self.x[routes])}
        return page

    def _split(self, at: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
        """Routing objects far from each other, and the members nearest to each."""
        x = self.x[at]
        routes, near = [0], _distances(x, x[0])
        owner = np.zeros(len(at), dtype=int)
        while len(routes) < FANOUT and near.max() > 0:
            far = int(near.argmax())
            d = _distances(x, x[far])
            owner[d < near] = len(routes)
            near = np.minimum(near, d)
            routes.append(far)
        parts = [np.flatnonzero(owner == k) for k in range(len(routes))]
        if max(map(len, parts)) > 0.9 * len(at):  # copies, or one dense heap: cut by id instead
            order = np.argsort(self.ids[at], kind="stable")
            parts = [p for p in np.array_split(order, FANOUT) if len(p)]
            routes = [int(p[0]) for p in parts]
        return [int(at[r]) for r in routes], [at[p] for p in parts]


class Tree:
    """Search over the pages of one shard."""

    def __init__(self, pages: pd.DataFrame, dims: int, top: int):
        self.top, self.pages = top, {}
        for p in pages.itertuples():
            ids = np.asarray(p.ids, dtype=np.int64)
            vectors = (np.frombuffer(p.vectors, dtype=np.int64).reshape(-1, dims) if p.leaf
                       else np.frombuffer(p.vectors, dtype=float).reshape(-1, dims + 1))
            self.pages[p.page] = (p.leaf, ids if p.leaf else ids.reshape(-1, 2), vectors,
                                  np.asarray(p.radii, dtype=float), np.asarray(p.parents, dtype=float))
        self.copies = {p.page: np.asarray(p.copies, dtype=np.int64) for p in pages.itertuples() if p.leaf}

    def best(self, query_id: int, q: np.ndarray, k: int, limit: tuple[int, int] | None) -> tuple[list[tuple], int]:
        """The k best (score, -vec_id, copies) that beat ``limit``, and how many distances were computed."""
        lifted, whole = np.append(q.astype(float), 0.0), float((q * q).sum()) + self.top
        slack = SLACK + ROUNDING * whole
        found: list[tuple] = []  # smallest first
        computed = 0
        floor = (limit[0], -limit[1]) if limit else None

        def worst():
            """What an entry must beat, as (score, -vec_id)."""
            return max(found[0][:2], floor) if len(found) == k and floor else found[0][:2] if len(found) == k else floor

        # (distance below which nothing lies, page, distance of the query to the page's parent or None)
        queue: list[tuple[float, int, float | None]] = [(0.0, 0, None)]
        while queue:
            low, page, to_parent = heapq.heappop(queue)
            bar = worst()
            if bar is not None and (whole - low * low) / 2 + slack < bar[0]:
                break  # nothing nearer is left in the queue
            leaf, ids, vectors, radii, parents = self.pages[page]
            reach = radii if len(radii) else 0.0
            open_ = np.ones(len(ids), dtype=bool)
            if bar is not None and to_parent is not None:
                gap = np.maximum(np.abs(to_parent - parents) - reach, 0.0)
                open_ = (whole - gap * gap) / 2 + slack >= bar[0]
            at = np.flatnonzero(open_)
            computed += len(at)
            if leaf:
                scores = vectors[at] @ q
                if bar is not None:
                    at, scores = at[scores >= bar[0]], scores[scores >= bar[0]]
                for score, vec_id, n in zip(scores.tolist(), ids[at].tolist(), self.copies[page][at].tolist(), strict=True):
                    one = (score, -vec_id, n)
                    if vec_id == query_id or (bar is not None and one[:2] <= bar):
                        continue
                    (heapq.heappush if len(found) < k else heapq.heappushpop)(found, one)
                    bar = worst()
                continue
            d = _distances(vectors[at], lifted)
            lows = np.maximum(d - radii[at], 0.0)
            tops = np.floor((whole - lows * lows) / 2 + slack)
            for i, distance, nearest, most in zip(at, d, lows, tops, strict=True):
                if bar is None or (most, -ids[i, 1]) > bar:
                    heapq.heappush(queue, (float(nearest), int(ids[i, 0]), float(distance)))
        return found, computed


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, regions: int = REGIONS, shard: int = SHARD,
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score).  Both inputs are rows of ``to_integers``."""
    spark = vectors.sparkSession
    ship_package(spark)
    every_vector = stage(vectors, "vectors")
    every_query = stage(queries.withColumnRenamed("vec_id", "query_id").withColumn("qhash", F.xxhash64("v", "wide")).drop("copies"), "queries")
    order = Window.partitionBy("query_id", "qhash").orderBy(F.desc("score"), "vec_id")
    vectors, queries = every_vector.where("v IS NOT NULL"), every_query.where("v IS NOT NULL").select("query_id", "qhash", "v")
    found = _indexed(vectors, queries, k, regions, shard, query_block, order)
    rows = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least("copies", F.lit(k).cast("long")))))
    if not every_vector.where("wide IS NOT NULL").isEmpty():
        wide = _exact_blocks(every_query, every_vector, k)
        digits = rows.select("query_id", "qhash", "vec_id", F.col("score").cast("string").alias("digits")).unionByName(wide)
        rows = digits.select("query_id", "qhash", "vec_id", F.col("digits").try_cast("long").alias("score"), _sortable(F.col("digits")).alias("key"))
        order = Window.partitionBy("query_id", "qhash").orderBy(F.desc("key"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


# Beyond any product of two vectors of float64 numbers: 2 x (1024 + scale) bits and room for their sum.
_OFFSET = 1 << 2400


def _sortable(digits: Column) -> Column:
    """Texts in the order of the whole numbers that the digits are."""

    @F.pandas_udf("string")
    def key(values: pd.Series) -> pd.Series:
        return values.map(lambda x: f"{int(x) + _OFFSET:0608x}")

    return key(digits)


def _exact_blocks(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """(query_id, qhash, vec_id, digits): at least the k best of the pairs that the trees leave out.

    That is wide queries with all vectors, other queries with wide ones; rows of a vector count each.
    """

    def whole(v, wide, scale) -> list[int]:
        return [math.floor(int(x) * scale if abs(x) >= 2.0**53 else x * scale) for x in wide] if wide is not None else [int(x) for x in v]

    def floats(rows: list[list[int]], dims: int) -> np.ndarray:
        out = np.zeros((len(rows), dims))
        for i, row in enumerate(rows):
            out[i, : len(row)] = [float(x) if abs(x) < 1 << 1000 else np.inf for x in row]
        return out

    def search(key: tuple, asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        rows = [whole(*r) for r in zip(held["v"], held["wide"], held["scale"], strict=True)]
        is_wide, ids, copies = held["wide"].notna().to_numpy(), held["vec_id"].tolist(), held["copies"].tolist()
        for q in asked.itertuples():
            one = whole(q.v, q.wide, q.scale)
            allowed = (is_wide | (q.wide is not None)) & (held["vec_id"].to_numpy() != q.query_id)
            at = np.flatnonzero(allowed)
            if not len(at):
                continue
            dims = max(len(one), *(len(rows[i]) for i in at))
            with np.errstate(all="ignore"):
                x, y = floats([rows[i] for i in at], dims), floats([one], dims)[0]
                top = max(np.abs(y).max(initial=0.0), 1.0)
                score, room = x @ (y / top), 1e-11 * (np.abs(x) @ np.abs(y / top)) + 1e-300
                low = np.sort(np.where(np.isfinite(score - room), score - room, -np.inf))[::-1]
                bar = low[k - 1] if len(low) >= k else -np.inf
                keep = at[~(score + room < bar)]
            exact = sorted(((-sum(a * b for a, b in zip(one, rows[i])), ids[i], copies[i]) for i in keep))[:k]
            out += [(q.query_id, q.qhash, vec_id, str(-minus)) for minus, vec_id, n in exact for _ in range(min(n, k))]
        return pd.DataFrame(out, columns=["query_id", "qhash", "vec_id", "digits"])

    blocks = max(1, -(-queries.count() // WIDE_QUERIES))
    deal = lambda n, *c: F.pmod(F.xxhash64(*c), F.lit(n)).cast("int")
    rows = max(1, -(-vectors.count() // ROW_BLOCK))
    asked = queries.withColumn("q", deal(blocks, "query_id", "qhash")).withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(rows - 1))))
    held = vectors.withColumn("r", deal(rows, "vec_id")).withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return asked.groupBy("q", "r").cogroup(held.groupBy("q", "r")).applyInPandas(search, "query_id long, qhash long, vec_id long, digits string")


def _indexed(vectors: DataFrame, queries: DataFrame, k: int, regions: int, shard: int, query_block: int, order) -> DataFrame:
    """(query_id, qhash, vec_id, score, copies): at least the k best of vectors and queries that are not wide."""
    spark = vectors.sparkSession
    squares = F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x * x)
    n, dims, top = vectors.agg(F.count("*"), F.max(F.size("v")), F.max(squares)).first()
    empty = "query_id long, qhash long, vec_id long, score long, copies long"
    n_queries = queries.count()
    if not n or not n_queries or not dims:
        top, dims = top or 0, max(dims or 1, 1)

    # Pivots: at most `regions` different vectors, those with the smallest hashes.
    wanted = max(1, min(regions, -(-(n or 1) // shard) * 4))
    chosen = vectors.select("v").distinct().orderBy(F.xxhash64("v")).limit(wanted).toArrow().column("v").combine_chunks()
    if not n:
        return spark.createDataFrame([], empty)
    pivots = lift(_matrix(chosen, dims), top)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = lift(_matrix(batch.column("v"), dims), top)
            d = np.stack([_distances(x, p) for p in pivots], axis=1)
            near = d.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), batch.column("copies"), pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(x)), near])],
                names=["vec_id", "v", "copies", "region", "distance"])

    placed = stage(vectors.select("vec_id", "v", "copies").mapInArrow(
        assign, "vec_id long, v array<long>, copies long, region int, distance double"), "placed")
    sizes = placed.groupBy("region").agg(F.count("*").alias("n"), F.max("distance").alias("radius")).collect()  # one per pivot
    shards = {r["region"]: -(-r["n"] // shard) for r in sizes}
    radius = {r["region"]: r["radius"] for r in sizes}
    cut = F.create_map(*[F.lit(x).cast("int") for r in shards.items() for x in r])
    sharded = placed.withColumn("shard", F.pmod(F.xxhash64("vec_id", F.lit(7)), F.element_at(cut, F.col("region"))).cast("int"))

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        v = np.zeros((len(rows), dims), dtype=np.int64)
        for i, x in enumerate(rows["v"]):
            v[i, : len(x)] = x
        pages = pd.DataFrame(Builder(rows["vec_id"].to_numpy(), v, top, rows["copies"].to_numpy()).pages)
        return pages.assign(region=key[0], shard=key[1])[[c.split()[0] for c in _PAGES.split(", ")]]

    pages = stage(sharded.groupBy("region", "shard").applyInPandas(build, _PAGES), "mtree-pages")

    # Which shards a query visits, from the distances to the pivots.
    blocks = -(-n_queries // query_block)
    radii = np.array([radius.get(r, -np.inf) for r in range(len(pivots))])

    def route(first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                q = _matrix(batch.column("v"), dims)
                lifted = np.hstack([q.astype(float), np.zeros((len(q), 1))])
                whole = (q * q).sum(1).astype(float) + top
                d = np.stack([_distances(lifted, p) for p in pivots], axis=1)
                low = np.where(np.isfinite(radii), np.maximum(d - radii, 0.0), np.inf)
                home = np.where(np.isfinite(radii), d, np.inf).argmin(1)
                rows = []
                for i in range(len(q)):
                    if first:
                        visit = [home[i]]
                    else:
                        bar = batch.column("bar")[i].as_py()
                        most = (whole[i] - low[i] ** 2) / 2 + SLACK + ROUNDING * whole[i]
                        visit = [r for r in np.flatnonzero(np.isfinite(low[i])) if r != home[i] and (bar is None or most[r] >= bar)]
                    rows += [(i, int(r), s) for r in visit for s in range(shards[int(r)])]
                at = pa.array([r[0] for r in rows], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(at) for c in ("query_id", "qhash", "v", "bar", "bar_id")),
                     pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int32())],
                    names=["query_id", "qhash", "v", "bar", "bar_id", "region", "shard"])

        return run

    routed = "query_id long, qhash long, v array<long>, bar long, bar_id long, region int, shard int"

    def search(key: tuple, asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(held):
            tree = Tree(held, dims, top)
            for r in asked.itertuples():
                q = np.zeros(dims, dtype=np.int64)
                q[: len(r.v)] = r.v
                limit = None if pd.isna(r.bar) else (int(r.bar), int(r.bar_id))
                found, _ = tree.best(r.query_id, q, k, limit)
                out += [(r.query_id, r.qhash, -minus, score, n) for score, minus, n in found]
        return pd.DataFrame(out, columns=["query_id", "qhash", "vec_id", "score", "copies"]).astype("int64")

    def visit(asked: DataFrame, first: bool) -> DataFrame:
        block = F.pmod(F.xxhash64("query_id", "qhash"), F.lit(blocks)).cast("int")
        sent = stage(asked.mapInArrow(route(first), routed).withColumn("block", block), "routed")
        # The pages of a shard, once for each block of queries that visits it.
        visited = sent.select(F.col("region").alias("_r"), F.col("shard").alias("_s"), F.col("block").alias("_b")).distinct()
        copies = pages.join(visited, (F.col("region") == F.col("_r")) & (F.col("shard") == F.col("_s"))).withColumn(
            "block", F.col("_b")).drop("_r", "_s", "_b")
        keys = ["region", "shard", "block"]
        return sent.groupBy(*keys).cogroup(copies.groupBy(*keys)).applyInPandas(search, empty)

    none = F.lit(None).cast("long")
    start = queries.withColumns({"bar": none, "bar_id": none})
    near = stage(visit(start, True), "near")
    # The k-th best of the first visit, where there are k.
    bars = near.withColumn("r", F.row_number().over(order)).where(F.col("r") == k).select(
        "query_id", "qhash", F.col("score").alias("bar"), F.col("vec_id").alias("bar_id"))
    again = queries.join(bars, ["query_id", "qhash"], "left").select("query_id", "v", "qhash", "bar", "bar_id")
    return near.unionByName(visit(again, False))
