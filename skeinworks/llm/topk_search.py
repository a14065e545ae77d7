"""Exact top-k search by inner product with a pivot-distance index.

Vectors get one more component that makes all norms equal, so that the largest inner product is the
least distance. Each vector is keyed by its nearest pivot and its distance to it; a cell is a pivot's
annulus between two distances. By the triangle inequality a query cannot be nearer to a cell's
vectors than its own distance to the pivot is to the annulus. Queries first search the annuli
nearest to them; their k-th score then bounds the distance, and of the other annuli, in order of that
lower bound, only those within it are searched.

Queries go in blocks of bounded size, which are sent to the index; the index itself is never
replicated, and a task keeps k rows of a query at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skeinworks.llm._common import batches, bounded_sample, materialise, partitions, ready

#: Pivots, annuli of each; vectors in the sample that both are fitted on; queries of a block.
PIVOTS, ANNULI, SAMPLE, QUERY_BLOCK = 32, 16, 2048, 4096
#: Distances are floating-point: bounds are widened by this share.
SLACK = 1e-6


def to_integers(docs: DataFrame, id_column: str, vector_column: str, scale: int = 256) -> DataFrame:
    """``vec_id, v`` (little-endian 64-bit integers): floor(scale x) of each component; rows with a null or non-finite one are left out."""
    rows = docs.select(docs[id_column].cast("long").alias("vec_id"), docs[vector_column].cast("array<double>").alias("x"))
    rows = rows.where("vec_id IS NOT NULL AND x IS NOT NULL").where(~F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    schema = pa.schema([("vec_id", pa.int64()), ("v", pa.binary())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            x = batch.column(1)
            scaled = np.floor(scale * x.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            if len(scaled) and np.abs(scaled).max() >= 2.0**62:
                raise OverflowError("a component leaves 64 bits")
            flat = scaled.astype("<i8")
            at = x.offsets.to_numpy() - x.offsets.to_numpy()[0]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([flat[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())], schema=schema)

    return rows.mapInArrow(run, "vec_id long, v binary")


def matrix(data: list[bytes], dim: int) -> np.ndarray:
    """Rows of integers; a shorter vector is filled up with zeros."""
    if all(len(d) == 8 * dim for d in data):
        return np.frombuffer(b"".join(data), "<i8").reshape(len(data), dim)
    return np.frombuffer(b"".join(d.ljust(8 * dim, b"\0") for d in data), "<i8").reshape(len(data), dim)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products: by floating point where every partial sum is below 2^53."""
    if len(q) and len(x) and float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1] < 2**53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q @ x.T


@dataclass
class Layout:
    """Pivots in the widened space, and the limits of their annuli."""

    dim: int
    norm: float  # the largest squared norm
    pivots: np.ndarray
    limits: np.ndarray  # (pivots, ANNULI - 1)

    def widened(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        x = x.astype(np.float64)
        extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.norm - (x * x).sum(axis=1), 0))
        return np.column_stack([x, extra])

    def distances(self, wide: np.ndarray) -> np.ndarray:
        p = self.pivots
        return np.sqrt(np.maximum((wide * wide).sum(axis=1)[:, None] + (p * p).sum(axis=1)[None] - 2 * wide @ p.T, 0))

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell and distance to its pivot of each vector."""
        d = self.distances(self.widened(x))
        pivot = d.argmin(axis=1)
        near = d[np.arange(len(x)), pivot]
        return pivot * ANNULI + (near[:, None] > self.limits[pivot]).sum(axis=1), near

    @classmethod
    def fit(cls, x: np.ndarray, dim: int, norm: float, seed: int = 3) -> Layout:
        """Pivots by a few rounds of means over the sample, limits by its quantiles."""
        layout = cls(dim, norm, np.zeros((1, dim + 1)), np.zeros((1, ANNULI - 1)))
        wide = layout.widened(x)
        rng = np.random.default_rng(seed)
        distinct = np.unique(wide, axis=0)
        layout.pivots = distinct[np.sort(rng.choice(len(distinct), min(PIVOTS, len(distinct)), replace=False))]
        for _ in range(8):
            own = layout.distances(wide).argmin(axis=1)
            layout.pivots = np.array([wide[own == p].mean(axis=0) if (own == p).any() else layout.pivots[p] for p in range(len(layout.pivots))])
        d = layout.distances(wide)
        own = d.argmin(axis=1)
        share = np.arange(1, ANNULI) / ANNULI
        layout.limits = np.array([np.quantile(d[own == p, p], share) if (own == p).any() else np.zeros(ANNULI - 1) for p in range(len(layout.pivots))])
        return layout


@dataclass
class Cells:
    """The index's cells: number, rows, and least and greatest distance to the pivot (at most PIVOTS * ANNULI)."""

    number: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def bounds(self, layout: Layout, q: np.ndarray) -> np.ndarray:
        """Least possible squared distance of each query to each cell."""
        d = layout.distances(layout.widened(q, query=True))[:, self.number // ANNULI]
        return np.maximum(np.maximum(self.low[None] - d, d - self.high[None]) * (1 - SLACK) - SLACK, 0) ** 2


def build(vectors: DataFrame) -> tuple[DataFrame, Layout, Cells]:
    """The index as a table in the shared folder (``cell, distance, vec_id, v``) and what the driver knows of it."""
    spark = ready(vectors)
    sizes = vectors.select(F.length("v").alias("n"), F.expr("v").alias("v")).mapInArrow(_norms, "n long, norm double").agg(F.max("n").alias("n"), F.max("norm").alias("norm")).first()
    dim, norm = (sizes.n or 0) // 8, float(sizes.norm or 0)
    if norm >= 2.0**62:  # no inner product is larger than the largest squared norm
        raise OverflowError("inner products may leave 64 bits")
    sample = bounded_sample(vectors, "vec_id", SAMPLE).collect()
    layout = Layout.fit(matrix([bytes(r.v) for r in sorted(sample, key=lambda r: (r.vec_id, bytes(r.v)))], dim) if sample else np.zeros((1, dim), np.int64), dim, norm)

    def key(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            cell, distance = layout.cells(matrix(batch.column(1).to_pylist(), dim))
            yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(distance), *batch.columns], names=["cell", "distance", "vec_id", "v"])

    # Rows are dealt out by id, so a hot cell is spread; the sort lets readers skip cells.
    keyed = vectors.mapInArrow(key, "cell int, distance double, vec_id long, v binary")
    index = materialise(keyed.repartition(partitions(spark), "vec_id").sortWithinPartitions("cell", "distance", "vec_id"), "pivot-index")
    known = index.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("distance").alias("low"), F.max("distance").alias("high")).collect()
    known.sort(key=lambda r: r.cell)
    return index, layout, Cells(*(np.array([r[i] for r in known], dtype=t) for i, t in enumerate((np.int64, np.int64, float, float))))


def _norms(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(it):
        x = [np.frombuffer(b, "<i8").astype(np.float64) for b in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array([float((v * v).sum()) for v in x])], names=["n", "norm"])


def _search(index: DataFrame, dim: int, cells: np.ndarray, ids: np.ndarray, q: np.ndarray, wanted: np.ndarray, least: np.ndarray, k: int) -> DataFrame:
    """For each query, the best k of each task in its wanted cells that score ``least`` or more. wanted: (queries, cells)."""
    used = wanted.any(axis=0)
    cells, packed = cells[used], np.packbits(wanted[:, used], axis=0)
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = np.unpackbits(packed, axis=0, count=len(ids)).astype(bool)
        place = {c: i for i, c in enumerate(cells.tolist())}
        floor = least.copy()
        best = np.zeros((3, 0), dtype=np.int64)  # query's number, vec_id, score

        def cut() -> None:
            """Keeps k rows of each query, and raises its floor to the k-th score."""
            nonlocal best
            best = best[:, np.lexsort((best[1], -best[2], best[0]))]
            rank = np.arange(best.shape[1]) - np.searchsorted(best[0], best[0])
            last = rank == k - 1
            floor[best[0][last]] = np.maximum(floor[best[0][last]], best[2][last])
            best = best[:, rank < k]

        for batch in batches(it):
            cell = batch.column(0).to_numpy()
            vec, x = batch.column(1).to_numpy(), matrix(batch.column(2).to_pylist(), dim)
            for c in np.unique(cell).tolist():
                who, rows = np.flatnonzero(mask[:, place[c]]), np.flatnonzero(cell == c)
                for at in range(0, len(who), 512):
                    part = who[at : at + 512]
                    scores = products(q[part], x[rows])
                    a, b = np.nonzero((scores >= floor[part][:, None]) & (ids[part][:, None] != vec[rows][None]))
                    best = np.concatenate([best, np.stack([part[a], vec[rows[b]], scores[a, b]])], axis=1)
            if best.shape[1] > 8 * k * len(ids) + 100_000:
                cut()
        if best.shape[1]:
            cut()
            yield pa.RecordBatch.from_arrays([pa.array(ids[best[0]]), pa.array(best[1]), pa.array(best[2])], schema=schema)

    rows = index.where(F.col("cell").isin(cells.tolist())).select("cell", "vec_id", "v")
    return rows.mapInArrow(run, "query_id long, vec_id long, score long")


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(table: DataFrame, is_query: Column, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = 256) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k best other vectors, ties to the smaller id.

    ``is_query`` tells queries by ``vec_id``. Null ids, null vectors and those with a null or
    non-finite component take no part; shorter vectors count as filled up with zeros; rows with a
    query's id are its own; repeated rows are candidates of their own, repeated queries are one;
    fewer than k candidates are all returned; an empty table gives none. Components so large that a
    score could leave 64 bits raise an error.
    """
    spark = ready(table)
    vectors = materialise(to_integers(table, id_column, vector_column, scale), "vectors")
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if vectors.isEmpty():
        return empty
    index, layout, cells = build(vectors)
    queries = index.where(is_query)
    # Blocks of queries: neighbouring cells together, a cell with many queries in several parts.
    counts = sorted((r.cell, r["count"]) for r in queries.groupBy("cell").count().collect())
    blocks: list[tuple[list[int], int, int]] = []
    held, total = [], 0
    for cell, n in counts:
        if held and total + n > QUERY_BLOCK:
            blocks.append((held, 0, 1))
            held, total = [], 0
        if n > QUERY_BLOCK:
            parts = -(-2 * n // QUERY_BLOCK)
            blocks += [([cell], i, parts) for i in range(parts)]
        else:
            held, total = [*held, cell], total + n
    if held:
        blocks.append((held, 0, 1))
    found = None
    for own, part, parts in blocks:
        mine = queries.where(F.col("cell").isin(own))
        if parts > 1:
            mine = mine.where(F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(parts)) == part)
        got = sorted((r.vec_id, bytes(r.v)) for r in mine.select("vec_id", "v").distinct().collect())
        if not got:
            continue
        ids, q = np.array([i for i, _ in got], dtype=np.int64), matrix([v for _, v in got], layout.dim)
        lower = cells.bounds(layout, q)
        order = np.argsort(lower, axis=1, kind="stable")
        # First the nearest annuli, as many as hold some multiple of k rows.
        enough = np.cumsum(cells.rows[order], axis=1) - cells.rows[order] < 8 * k + 1
        first = np.zeros(lower.shape, dtype=bool)
        np.put_along_axis(first, order, enough, axis=1)
        least = np.full(len(ids), np.iinfo(np.int64).min)
        near = materialise(_top(_search(index, layout.dim, cells.number, ids, q, first, least, k), k), "near")
        place = {i: n for n, i in enumerate(ids.tolist())}
        if len(place) == len(ids):
            for r in near.where(F.col("rank") == k).collect():  # a row for each query of the block at most
                least[place[r.query_id]] = r.score
        # Then every annulus that may hold a better or equal vector.
        known = least > np.iinfo(np.int64).min
        reach = np.where(known, (q.astype(np.float64) ** 2).sum(axis=1) + layout.norm - 2.0 * np.where(known, least, 0), np.inf)
        second = (lower <= reach[:, None] * (1 + SLACK) + SLACK) & ~first
        answer = near.select("query_id", "vec_id", "score")
        if second.any():
            answer = answer.unionByName(_search(index, layout.dim, cells.number, ids, q, second, least, k))
        answer = _top(answer, k)
        if len(blocks) > 8:
            answer = materialise(answer, "answers")  # keeps the plan short
        found = answer if found is None else found.unionByName(answer)
    return empty if found is None else found
