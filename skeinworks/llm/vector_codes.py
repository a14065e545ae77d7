"""Codes of vectors by one codebook for each of their parts, found with segment-mean lower bounds.

A part and an entry are compared coarse to fine: over blocks of components, the distance is at least
that of the block means plus that of the norms of what the means leave over. The bounds, widened by
more than their rounding, only rule out entries that cannot be nearest; survivors get exact integer
distances. A round of training sums a task's parts by entry, so what is shuffled and what reaches the
driver follows the size of the codebooks alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinworks.llm._common import attach, batches, materialise, ready

#: Bounds are floating-point: an entry is ruled out only beyond this share of the squared norms.
SLACK = 1e-9
#: Components below this are compared in 64 bits, others in integers of any length.
NARROW = 1 << 26


def to_integers(table: DataFrame, id_column: str, vector_column: str, label_column: str, scale: int) -> DataFrame:
    """``vec_id, label, v`` (little-endian 64-bit integers): floor(scale x); rows with a null vector or a null or non-finite component are left out."""
    rows = table.select(table[id_column].cast("long").alias("vec_id"), table[label_column].alias("label"), table[vector_column].cast("array<double>").alias("x"))
    rows = rows.where("x IS NOT NULL").where(~F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    kind = rows.schema["label"].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            x = batch.column(2)
            scaled = np.floor(scale * x.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            if len(scaled) and np.abs(scaled).max() >= 2.0**62:
                raise OverflowError("a component leaves 64 bits")
            flat, at = scaled.astype("<i8"), x.offsets.to_numpy() - x.offsets.to_numpy()[0]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([flat[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())], names=["vec_id", "label", "v"])

    return rows.mapInArrow(run, f"vec_id long, label {kind}, v binary")


def cut(data: list[bytes], parts: int, width: int) -> np.ndarray:
    """(vectors, parts, width); shorter vectors are filled up with zeros."""
    size = 8 * parts * width
    return np.frombuffer(b"".join(d.ljust(size, b"\0") for d in data), "<i8").reshape(len(data), parts, width)


def segments(x: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block means times the root of the block's length, and the norm of what they leave over. x: (rows, width)."""
    edges = np.linspace(0, x.shape[1], blocks + 1).astype(int)
    sizes = np.diff(edges)
    means = np.add.reduceat(x, edges[:-1], axis=1) / sizes
    rest = x - np.repeat(means, sizes, axis=1)
    return means * np.sqrt(sizes), np.sqrt((rest * rest).sum(axis=1))


def exact(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows to rows as integers, of any length where 64 bits might not hold them."""
    if max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0))) >= NARROW or x.shape[-1] >= 256:
        x, c = x.astype(object), c.astype(object)
    d = x - c
    return (d * d).sum(axis=-1)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and exact squared distance to the nearest entry of each row, ties to the lower index. x: (rows, width), book: (entries, width)."""
    xf, cf = x.astype(np.float64), book.astype(np.float64)
    slack = SLACK * ((xf * xf).sum(axis=1) + (cf * cf).sum(axis=1).max()) + SLACK
    means, rest = segments(xf, 1)
    c_means, c_rest = segments(cf, 1)
    bound = (means - c_means[:, 0]) ** 2 + (rest[:, None] - c_rest[None]) ** 2
    guess = bound.argmin(axis=1)
    reach = exact(x, book[guess]).astype(np.float64) + slack
    row, entry = np.nonzero(bound <= reach[:, None])
    blocks = 2
    while blocks < x.shape[1]:
        means, rest = segments(xf, blocks)
        c_means, c_rest = segments(cf, blocks)
        near = ((means[row] - c_means[entry]) ** 2).sum(axis=1) + (rest[row] - c_rest[entry]) ** 2 <= reach[row]
        row, entry = row[near], entry[near]
        blocks *= 2
    distance = exact(x[row], book[entry])  # each row keeps its guess, so none is without a survivor
    first = np.searchsorted(row, np.arange(len(x)))
    least = np.minimum.reduceat(distance, first)
    best = np.flatnonzero(distance == least[row])
    best = best[np.searchsorted(row[best], np.arange(len(x)))]
    return entry[best], least


def _trained(vectors: DataFrame, book: np.ndarray) -> np.ndarray:
    """The codebooks after one round. book: (parts, entries, width)."""
    parts, entries, width = book.shape

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches(it):
            x = cut(batch.column(0).to_pylist(), parts, width)
            if float(np.abs(x).max(initial=0)) * 2**20 + float(np.abs(sums).max()) >= 2.0**62:
                raise OverflowError("a sum of components may leave 64 bits")
            for p in range(parts):
                index, _ = nearest(x[:, p], book[p])
                np.add.at(sums[p], index, np.column_stack([x[:, p], np.ones(len(x), np.int64)]))
        used = np.flatnonzero(sums)
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums.ravel()[used])], names=["place", "total"])

    sums = np.zeros(parts * entries * (width + 1), object)
    for r in vectors.select("v").mapInArrow(run, "place long, total long").groupBy("place").agg(F.sum(F.col("total").cast("decimal(28,0)")).alias("total")).collect():
        sums[r.place] = int(r.total)
    sums = sums.reshape(parts, entries, width + 1)
    out = book.copy()
    for p, e in np.argwhere(sums[..., -1] > 0):
        out[p, e] = [t // sums[p, e, -1] for t in sums[p, e, :-1]]
    return out


def codebooks(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2) -> np.ndarray:
    """(parts, entries, width) integers, begun with the vectors of the least ids. ``vectors`` from ``to_integers``, written to a table."""
    widest = vectors.agg(F.max(F.length("v")).alias("n")).first().n or 0
    width = max(1, -(-(widest // 8) // parts))
    begin = [bytes(r.v) for r in vectors.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).collect()]
    book = cut(begin, parts, width).transpose(1, 0, 2).copy()
    for _ in range(rounds if begin else 0):
        book = _trained(vectors, book)
    return book


def compress(table: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", scale: int = 256) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` for every vector.

    Null vectors and those with a null or non-finite component are left out. A shorter vector counts
    as filled up with zeros to the widest, and that to a multiple of ``parts``; an empty one is all
    zeros. Null ids stay and come last where the codebooks begin; repeated rows are rows of their own;
    with fewer vectors than ``entries`` the codebooks are that much shorter. Null labels are one
    label. An empty table gives no row. Components or errors that leave 64 bits raise an error.
    """
    spark = ready(table)
    vectors = materialise(to_integers(table, id_column, vector_column, label_column, scale), "integers")
    book = codebooks(vectors, parts, entries, rounds)
    n_parts, n_entries, width = book.shape
    digest = hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()
    kind = vectors.schema["label"].dataType.simpleString()
    digits = np.array([f"{i:02x}" for i in range(max(n_entries, 1))])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            x = cut(batch.column(2).to_pylist(), n_parts, width)
            found = [nearest(x[:, p], book[p]) for p in range(n_parts)]
            code = np.array([digits[index] for index, _ in found]).T
            error = np.sum([d.astype(object) for _, d in found], axis=0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(["".join(c) for c in code]), pa.array(error.tolist(), pa.int64())], names=["vec_id", "label", "code", "error"])

    coded = materialise(vectors.mapInArrow(run, f"vec_id long, label {kind}, code string, error long"), "codes")
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("_n"))
    return attach(coded, materialise(sums, "label-errors"), ["label"]).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
