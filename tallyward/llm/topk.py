"""Exact top-k by inner product over a pivot-distance index.

One more component turns the largest inner product into the least distance: with
x' = (x, sqrt(M - |x|^2)) and q' = (q, 0), |q' - x'|^2 = |q|^2 + M - 2 qx. Each
vector is keyed by its nearest pivot and its distance to it; the distances of a
pivot are cut into annuli, the cells of the index. A query first searches the cell
it lies in. Its k-th score there bounds the distance of anything better, so by the
triangle inequality it goes on to those cells only whose annulus comes that near,
and within a cell from strip to strip, nearest first, until a strip is too far.

Equal vectors are kept once with their least ids, as many as can matter; equal
queries are searched once. Cells with many vectors and cells with many queries
are split, so that no task holds more than a block of either.

Defined results: vectors that are NULL or hold NULL or non-finite components take
no part, nor do NULL ids; repeated rows count once. A shorter vector counts as
filled up with zeros. Ties go to the smaller id; fewer candidates give fewer rows.
Scores are exact; one that does not fit a long is the nearest long that is not the
least, and so are components of that size. Such scores tie.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.sources.staging import stage

PIVOTS = 16
MOST_PIVOTS = 256
"""Pivots grow with the square root of the vectors, between these bounds: cells then keep pruning as vectors grow."""
ANNULI = 4
BLOCK = 8192
"""Vectors, and queries, of a task, about."""
STRIP = 512
EXACT = 1 << 53
MOST = (1 << 63) - 1


def integral(vectors: DataFrame, *, key: str, vector: str, scale: float) -> DataFrame:
    """vec_id and v: floor(scale * x) of each component, of the vectors that take part."""
    source = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("x")).where(
        "vec_id IS NOT NULL AND x IS NOT NULL")
    sound = F.forall("x", lambda c: c.isNotNull() & (F.abs(c) < math.inf))
    return source.where(sound).select(
        "vec_id", F.transform("x", lambda c: F.floor(F.lit(float(scale)) * c)).alias("v")).distinct()


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of integers, filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy()
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products, by floating-point arithmetic where that is exact, and without bound where longs are too short."""
    def largest(x: np.ndarray) -> int:
        return max(-int(x.min(initial=0)), int(x.max(initial=0)))

    most = largest(a) * largest(b) * max(1, a.shape[1])
    if most < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most <= MOST:
        return a @ b.T
    return np.clip(a.astype(object) @ b.T.astype(object), -MOST, MOST).astype(np.int64)


class Index:
    """Pivots, the annuli around them, and what bounds need; its size does not depend on the data."""

    def __init__(self, pivots: np.ndarray, most: int, edges: np.ndarray) -> None:
        self.pivots, self.most, self.edges = pivots, most, edges
        self.inner = np.zeros((0, 0))
        self.outer = np.zeros((0, 0))
        self.parts = np.ones((0, 0), dtype=np.int64)

    @property
    def width(self) -> int:
        return self.pivots.shape[1] - 1

    def lifted(self, v: np.ndarray) -> np.ndarray:
        rest = self.most - np.einsum("ij,ij->i", v.astype(np.float64), v.astype(np.float64))
        return np.column_stack([v, np.sqrt(np.maximum(rest, 0))])

    def distances(self, points: np.ndarray) -> np.ndarray:
        square = (points**2).sum(axis=1)[:, None] + (self.pivots**2).sum(axis=1) - 2 * points @ self.pivots.T
        return np.sqrt(np.maximum(square, 0))

    def annulus(self, pivot: np.ndarray, distance: np.ndarray) -> np.ndarray:
        return (distance[:, None] > self.edges[pivot]).sum(axis=1)


def best(
    queries: np.ndarray, ids: list, floor: np.ndarray, points: np.ndarray, candidates: list[list[int]],
    near: np.ndarray, far: np.ndarray, radius: np.ndarray, reach: np.ndarray, k: int,
) -> Iterator[tuple[int, int, int]]:
    """(query id, candidate id, score) of each query's k best of a block with at least its floor.

    ``radius``: the block's distances to its pivot, rising; ``reach``: the
    queries' distances to it; ``near`` and ``far`` give |q|^2 + M and the slack.
    """
    count = len(queries)
    kept_score = np.full((count, k), -MOST)
    kept_row = np.full((count, k), -1)
    least_id = np.array([c[0] for c in candidates])
    starts = list(range(0, len(points), STRIP))
    middle = np.array([radius[(s + min(s + STRIP, len(points)) - 1) // 2] for s in starts])
    for strip in np.argsort(np.abs(middle - np.median(reach))) if starts else []:
        lo, hi = starts[strip], min(starts[strip] + STRIP, len(points))
        bound = np.maximum(floor, kept_score[:, -1])
        ball = np.sqrt(np.maximum(near - 2.0 * bound.astype(np.float64), 0)) + far
        gap = np.maximum(np.maximum(radius[lo] - reach, reach - radius[hi - 1]), 0)
        go = np.flatnonzero(gap <= ball)
        if not len(go):
            continue
        found = scores(queries[go], points[lo:hi])
        both_score = np.concatenate([kept_score[go], found], axis=1)
        both_row = np.concatenate([kept_row[go], np.broadcast_to(np.arange(lo, hi), found.shape)], axis=1)
        tie = np.where(both_row >= 0, least_id[both_row], np.iinfo(np.int64).max)
        order = np.lexsort((tie, -both_score), axis=1)[:, :k]
        kept_score[go] = np.take_along_axis(both_score, order, axis=1)
        kept_row[go] = np.take_along_axis(both_row, order, axis=1)
    for q in range(count):
        rows = [
            (-int(s), c) for s, r in zip(kept_score[q], kept_row[q], strict=True) if r >= 0 and s >= floor[q]
            for c in candidates[r]
        ]
        for negative, c in sorted(rows)[:k]:
            yield ids[q], c, -negative


def build(vectors: DataFrame, k: int) -> tuple[DataFrame, Index | None]:
    """The index table (v, ids, pivot, annulus, distance, part) and its fixed part."""
    each = Window.partitionBy("v").orderBy("vec_id")
    # of equal vectors the k least ids are enough; the window drops the rest before the shuffle
    distinct = stage(vectors.withColumn("place", F.row_number().over(each)).where(F.col("place") <= k).groupBy("v").agg(
        F.array_sort(F.collect_list("vec_id")).alias("ids")), "topk-distinct")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    size = distinct.agg(F.max(square).alias("most"), F.max(F.size("v")).alias("width"), F.count("*").alias("n")).first()
    if size["most"] is None:
        return distinct, None
    width = max(1, size["width"])
    pivots = min(MOST_PIVOTS, max(PIVOTS, math.isqrt(size["n"]) // PIVOTS))
    chosen = [r["v"] for r in distinct.orderBy(F.xxhash64("v"), "v").limit(pivots).select("v").collect()]
    index = Index(np.zeros((1, width + 1)), size["most"], np.zeros((len(chosen), 0)))
    index.pivots = index.lifted(np.array([c + [0] * (width - len(c)) for c in chosen], dtype=np.int64))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = index.distances(index.lifted(matrix(batch.column("v"), width)))
            nearest = apart.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([
                batch.column("v"), batch.column("ids"), pa.array(nearest.astype(np.int32)),
                pa.array(apart[np.arange(len(nearest)), nearest]),
            ], names=["v", "ids", "pivot", "distance"])

    placed = stage(distinct.mapInArrow(assign, "v array<long>, ids array<long>, pivot int, distance double"), "topk-placed")
    shares = F.array(*(F.lit((i + 1) / ANNULI) for i in range(ANNULI - 1)))
    cuts = {r["pivot"]: r["cuts"] for r in placed.groupBy("pivot").agg(
        F.percentile_approx("distance", shares, 1000).alias("cuts")).collect()}
    index.edges = np.array([cuts.get(p, [0.0] * (ANNULI - 1)) for p in range(len(chosen))])
    edges = F.array(*(F.array(*map(F.lit, row)) for row in index.edges.tolist()))
    ring = F.size(F.filter(edges[F.col("pivot")], lambda e: F.col("distance") > e))
    ringed = placed.withColumn("annulus", ring)
    index.inner = np.full((len(chosen), ANNULI), math.inf)
    index.outer = np.full((len(chosen), ANNULI), -math.inf)
    index.parts = np.zeros((len(chosen), ANNULI), dtype=np.int64)
    for r in ringed.groupBy("pivot", "annulus").agg(
            F.min("distance").alias("lo"), F.max("distance").alias("hi"), F.count("*").alias("n")).collect():
        at = r["pivot"], r["annulus"]
        index.inner[at], index.outer[at], index.parts[at] = r["lo"], r["hi"], -(-r["n"] // BLOCK)
    parts = F.array(*(F.array(*map(F.lit, row)) for row in index.parts.tolist()))
    part = F.pmod(F.xxhash64("v"), parts[F.col("pivot")][F.col("annulus")]).cast("int")
    return ringed.withColumn("part", part), index


def search(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best candidates but itself; both have vec_id and v."""
    spark = vectors.sparkSession
    out = "key long, vec_id long, score long"
    more = k + 1  # the query itself may be among its best
    table, index = build(vectors, more)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    asked = stage(queries.select("vec_id", "v"), "topk-asked")
    unique = stage(asked.groupBy("v").agg(F.min("vec_id").alias("key")), "topk-unique")
    groups = max(1, -(-unique.count() // BLOCK))
    width = index.width

    def visits(first: bool):
        kinds = [("cell", pa.int32()), ("part", pa.int32()), ("qpart", pa.int32()), ("key", pa.int64()), ("v", pa.list_(pa.int64())), ("floor", pa.int64())]
        schema = pa.schema(kinds)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                q = matrix(batch.column("v"), width)
                apart = index.distances(np.column_stack([q, np.zeros(len(q))]))
                key = batch.column("key").to_numpy()
                # the home: the nearest cell with vectors
                gap = np.maximum(np.maximum(index.inner[None] - apart[:, :, None], apart[:, :, None] - index.outer[None]), 0)
                gap = gap.reshape(len(q), -1)
                filled = index.parts.reshape(-1) > 0
                home = np.argmin(np.where(filled, gap, math.inf), axis=1)
                if first:
                    go = np.zeros(gap.shape, dtype=bool)
                    go[np.arange(len(q)), home] = True
                    floor = np.full(len(q), -MOST)
                else:
                    floor = batch.column("floor").to_numpy()
                    square = (q.astype(np.float64)**2).sum(axis=1) + index.most
                    ball = np.sqrt(np.maximum(square - 2.0 * floor, 0)) + slack(index)
                    go = filled & (gap <= ball[:, None])
                    go[np.arange(len(q)), home] = False
                row, cell = np.nonzero(go)
                parts = index.parts.reshape(-1)[cell]
                part = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
                row, cell = np.repeat(row, parts), np.repeat(cell, parts)
                yield pa.RecordBatch.from_arrays([
                    pa.array(cell.astype(np.int32)), pa.array(part.astype(np.int32)),
                    pa.array((key[row] % groups).astype(np.int32)), pa.array(key[row]),
                    batch.column("v").take(pa.array(row)), pa.array(floor[row].astype(np.int64)),
                ], schema=schema)

        return run

    columns = "cell int, part int, qpart int, key long, v array<long>, floor long"
    stored = table.select((F.col("pivot") * ANNULI + F.col("annulus")).alias("cell"), "part", "v", "ids", "distance")

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        result = []
        if left.num_rows and right.num_rows:
            right = right.sort_by("distance")
            q, x = matrix(left.column("v"), width), matrix(right.column("v"), width)
            pivot = left.column("cell")[0].as_py() // ANNULI
            result = list(best(
                q, left.column("key").to_pylist(), left.column("floor").to_numpy(), x, right.column("ids").to_pylist(),
                (q.astype(np.float64)**2).sum(axis=1) + index.most, np.full(len(q), slack(index)),
                right.column("distance").to_numpy(),
                index.distances(np.column_stack([q, np.zeros(len(q))]))[:, pivot], more))
        columns = list(zip(*result, strict=True)) or [[], [], []]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["key", "vec_id", "score"])

    def round_of(asking: DataFrame) -> DataFrame:
        # a block of vectors goes to those blocks of queries that visit it
        by = ["cell", "part", "qpart"]
        asking = stage(asking, "topk-visits")
        visited = stored.join(asking.select(*(F.col(c).alias(c) for c in by)).distinct(), ["cell", "part"])
        return asking.groupBy(*by).cogroup(visited.groupBy(*by)).applyInArrow(look, out)

    first = stage(round_of(unique.mapInArrow(visits(True), columns)), "topk-first")
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "vec_id"))
    floors = first.withColumn("place", place).where(F.col("place") == more).select("key", F.col("score").alias("floor"))
    bounded = unique.join(floors, "key", "left").withColumn("floor", F.coalesce("floor", F.lit(-MOST)))
    second = round_of(bounded.mapInArrow(visits(False), columns))
    kept = stage(first.unionByName(second).withColumn("place", place).where(F.col("place") <= more).drop("place"), "topk-kept")
    own = asked.join(unique, "v").select(F.col("vec_id").alias("query_id"), "key")
    last = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return own.join(kept, "key").where("query_id <> vec_id").withColumn("rank", last).where(
        F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def slack(index: Index) -> float:
    """What rounding may take off a bound."""
    return 1e-6 * (1 + math.sqrt(float(index.most)))
