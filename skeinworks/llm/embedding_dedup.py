"""Near duplicates among embeddings of one label: cross-polytope hashing after fast Hadamard rotations.

Equal vectors of a label are one vector with a count. Each is rotated at random (three times signs,
then a Hadamard transform) and hashed to the nearest corner of the cross-polytope, the largest
component and its sign; a bucket of a table is named by several such hashes. Vectors also visit the
buckets that differ in one hash by its second-best corner. Pairs that meet in a bucket, one of them at
home there, are verified by their cosine in double precision, as products of blocks of rows. A pair
that meets several times counts at its first meeting; no list of pairs leaves a task, only counts and
the edges of a forest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinworks.llm._common import attach, batches, materialise, partitions, ready, spread
from skeinworks.operators.components import connected_components

#: Tables; hashes that name a bucket (a vector visits as many buckets of a table besides its own).
TABLES, HASHES = 6, 2
#: Rows of a bucket that are compared in one block; rows of a tile of products.
BLOCK, TILE = 4096, 128
#: Rows of the list of larger buckets that are broadcast at most; longer lists are joined by a shuffle.
LISTED = 100_000


def hadamard(x: np.ndarray) -> np.ndarray:
    """Each row times the Hadamard matrix, up to a factor. The width is a power of two."""
    rows, width = x.shape
    h = 1
    while h < width:
        y = x.reshape(rows, -1, 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(rows, width)
        h *= 2
    return x


def bucket_codes(x: np.ndarray, tables: int = TABLES, hashes: int = HASHES, seed: int = 11) -> np.ndarray:
    """(rows, tables, 1 + hashes): each row's own bucket in each table, then those that differ in one hash. x: unit rows."""
    width = max(16, 1 << (x.shape[1] - 1).bit_length())
    rng = np.random.default_rng(seed)
    wide = np.zeros((len(x), width))
    wide[:, : x.shape[1]] = x
    out = np.zeros((len(x), tables, 1 + hashes), np.int64)
    for t in range(tables):
        best, second = [], []
        for _ in range(hashes):
            y = wide
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], width)) / np.sqrt(width)
            size = np.abs(y)
            two = np.argpartition(-size, 1, axis=1)[:, :2]
            two = np.where((np.take_along_axis(size, two[:, :1], 1) >= np.take_along_axis(size, two[:, 1:], 1)), two, two[:, ::-1])
            corner = 2 * two + (np.take_along_axis(y, two, 1) < 0)
            best.append(corner[:, 0])
            second.append(corner[:, 1])
        for probe in range(1 + hashes):
            code = np.zeros(len(x), np.int64)
            for h in range(hashes):
                code = code * 2 * width + (second[h] if probe == h + 1 else best[h])
            out[:, t, probe] = code
    return out


def unit(data: list[bytes], kind: str, dim: int) -> np.ndarray:
    """Rows of length one in double precision; a shorter vector is filled up with zeros."""
    size = dim * np.dtype(kind).itemsize
    x = np.frombuffer(b"".join(d.ljust(size, b"\0") for d in data), kind).reshape(len(data), dim).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no square leaves the range of doubles
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def linked(x: np.ndarray, left: np.ndarray, right: np.ndarray, home: np.ndarray, codes: np.ndarray, table: int, code: int, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows (one of left, one of right) that are linked and meet first in this bucket. codes: (rows, tables, probes); home: at home here."""
    own = codes[:, :, 0]
    for at in range(0, len(left), TILE):
        mine = left[at : at + TILE]
        a, b = np.nonzero((x[mine] @ x[right].T >= least) & (home[mine][:, None] | home[right][None]))
        a, b = mine[a], right[b]
        once = a < b if left is right else np.ones(len(a), bool)
        a, b = a[once], b[once]
        # In each table: is one at home where the other is at home or visits?
        for s in range(table):
            met = (codes[b, s] == own[a, s][:, None]).any(axis=1) | (codes[a, s] == own[b, s][:, None]).any(axis=1)
            a, b = a[~met], b[~met]
        there = (codes[b, table] == own[a, table][:, None]).any(axis=1) & (codes[a, table] == own[b, table][:, None]).any(axis=1)
        first = ~there | (np.minimum(own[a, table], own[b, table]) == code)
        yield a[first], b[first]


def forest(n: int, a: np.ndarray, b: np.ndarray, root: np.ndarray | None = None) -> np.ndarray:
    """The least row that each row is connected to by the pairs and the connections in ``root``."""
    root = np.arange(n) if root is None else root
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(root[root], root):
            root = root[root]


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])


def _links(dealt: DataFrame, kind: str, dim: int, shape: tuple[int, int], least: float) -> DataFrame:
    """``a, b, n``: the number n of vectors that a is linked to by pairs that meet in a bucket first, or an edge from a to b (n null)."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def bucket(rows: pa.Table) -> pa.RecordBatch | None:
            home = rows["home"].to_numpy(zero_copy_only=False) if isinstance(rows["home"], pa.Array) else rows["home"].combine_chunks().to_numpy(zero_copy_only=False)
            if len(home) < 2 or not home.any():
                return None
            side = rows["side"].to_numpy()
            here = np.arange(len(home))
            left, right = (here, here) if not side.any() and rows["block"][0].as_py() == rows["other"][0].as_py() else (here[side == 0], here[side == 1])
            if not len(left) or not len(right):
                return None
            x = unit(rows["v"].to_pylist(), kind, dim)
            codes = np.array(rows["codes"].to_pylist(), np.int64).reshape(len(home), *shape)
            uid, copies = rows["uid"].to_numpy(), rows["copies"].to_numpy()
            links, root = np.zeros(len(home), np.int64), here.copy()
            for a, b in linked(x, left, right, home, codes, rows["t"][0].as_py(), rows["code"][0].as_py(), least):
                np.add.at(links, a, copies[b])
                np.add.at(links, b, copies[a])
                root = forest(len(home), a, b, root)
            some, far = np.flatnonzero(links), np.flatnonzero(root != here)
            if not len(some):
                return None
            return pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([uid[some], uid[far]])), pa.array([*[None] * len(some), *uid[root[far]].tolist()], pa.int64()), pa.array([*links[some].tolist(), *[None] * len(far)], pa.int64()),
            ], schema=LINKS)

        held: list[pa.RecordBatch] = []
        key = None
        for batch in batches(it):
            columns = [batch.column(c) for c in ("t", "code", "label", "block", "other")]
            changed = np.zeros(batch.num_rows, bool)
            for c in columns:
                changed[1:] |= pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False)
            begins = [0, *np.flatnonzero(changed).tolist(), batch.num_rows]
            for a, b in zip(begins[:-1], begins[1:], strict=True):
                now = tuple(c[a].as_py() for c in columns)
                if now != key:
                    if held and (out := bucket(pa.Table.from_batches(held))) is not None:
                        yield out
                    held, key = [], now
                held.append(batch.slice(a, b - a))
        if held and (out := bucket(pa.Table.from_batches(held))) is not None:
            yield out

    return dealt.mapInArrow(run, "a long, b long, n long")


def _visits(distinct: DataFrame, probes: int) -> DataFrame:
    """A row for each bucket that a vector is at home in (``home``) or visits: ``t, code, label, block, other, side`` and the vector.

    A bucket of more than BLOCK rows is compared in pairs of blocks, so that no task holds more than two of them.
    """
    place = distinct.select("*", F.posexplode("codes").alias("p", "code"))
    place = place.select("uid", "label", "copies", "v", "codes", "code", (F.col("p") / probes).cast("int").alias("t"), (F.col("p") % probes == 0).alias("home"))
    large = materialise(place.groupBy("t", "code", "label").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > BLOCK), "large-buckets")
    listed = large.count()
    if not listed:
        return place.select("*", *(F.lit(0).alias(c) for c in ("block", "other", "side")))
    large = large.select("t", "code", "label", F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks"))
    place = place.join(F.broadcast(large) if listed <= LISTED else large, ["t", "code", "label"], "left")
    own = F.when(F.col("blocks").isNull(), 0).otherwise(F.pmod(F.xxhash64("uid"), F.col("blocks"))).cast("int")
    place = place.withColumn("own", own).withColumn("with", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
    return place.select("uid", "label", "copies", "v", "codes", "code", "t", "home", F.least("own", "with").alias("block"), F.greatest("own", "with").alias("other"), (F.col("own") > F.col("with")).cast("int").alias("side"))


def near_duplicates(table: DataFrame, least: float = 0.98, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", tables: int = TABLES, hashes: int = HASHES) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every vector: how many others it is linked to, and the least id reachable by links.

    Vectors of equal labels link with a cosine of ``least`` or more. Null ids, null labels, vectors
    that are null, empty, zero or hold a null or non-finite component link with nothing; they are
    their own component, and kept. Equal vectors of a label link, whatever their ids; repeated rows
    are vectors of their own. A shorter vector counts as filled up with zeros. Other columns are
    ignored; an empty table gives no row. Links between pairs that meet in no bucket are missed (see
    the README for the recall measured).
    """
    spark = ready(table)
    kind = "float" if table.schema[vector_column].dataType.simpleString() == "array<float>" else "double"
    x = table[vector_column].cast(f"array<{kind}>")
    rows = table.select(table[id_column].cast("long").alias("vec_id"), table[label_column].cast("string").alias("label"), x.alias("x"))
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(~F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))) & F.exists("x", lambda c: c != 0), F.lit(False))
    # Zero has two signs and one meaning; two digests of 64 bits name a vector of a label where its copies are put back.
    rows = rows.withColumn("x", F.when(good, F.transform("x", lambda c: c + F.lit(0).cast(kind))))
    rows = rows.withColumns({"h1": F.when(F.col("x").isNotNull(), F.xxhash64("label", "x")), "h2": F.when(F.col("x").isNotNull(), F.xxhash64(F.lit(29), "x", "label"))})
    rows = materialise(spread(rows), "vectors")
    alone = rows.where("x IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    distinct = rows.where("x IS NOT NULL").groupBy("label", "x", "h1", "h2").agg(F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("copies"))
    dim = rows.agg(F.max(F.size("x")).alias("n")).first().n or 0
    if dim < 1:
        return _answer(alone)
    probes, letter = 1 + hashes, "<f4" if kind == "float" else "<f8"

    def coded(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            flat, at = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(letter), batch.column(1).offsets.to_numpy() - batch.column(1).offsets.to_numpy()[0]
            data = [flat[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
            codes = bucket_codes(unit(data, letter, dim), tables, hashes).reshape(len(data), -1)
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(data, pa.binary()), pa.array(codes.tolist(), pa.list_(pa.int64()))], names=["label", "h1", "h2", "least_id", "copies", "v", "codes"])

    distinct = distinct.select("label", "x", "h1", "h2", "least_id", "copies").mapInArrow(coded, "label string, h1 long, h2 long, least_id long, copies long, v binary, codes array<long>")
    distinct = materialise(distinct.withColumn("uid", F.monotonically_increasing_id()), "distinct-vectors")
    key = ["t", "code", "label", "block", "other"]
    dealt = _visits(distinct.select("uid", "label", "copies", "v", "codes"), probes).repartition(partitions(spark), *key).sortWithinPartitions(*key)
    met = materialise(_links(dealt, letter, dim, (tables, probes), least), "links")
    links = met.where("n IS NOT NULL").groupBy(F.col("a").alias("uid")).agg(F.sum("n").alias("found"))
    joined = connected_components(met.where("b IS NOT NULL").select("a", "b"))
    named = distinct.select("uid", "h1", "h2", "least_id", "copies")
    members = materialise(joined.select(F.col("node").alias("uid"), "component").join(named.select("uid", "least_id"), "uid"), "members")
    lowest = materialise(members.groupBy("component").agg(F.min("least_id").alias("component_id"), F.count(F.lit(1)).alias("_n")), "lowest")
    reached = attach(members, lowest, ["component"]).select("uid", "component_id")
    known = named.join(links, "uid", "left").join(reached, "uid", "left")
    known = known.select("h1", "h2", (F.col("copies") - 1 + F.coalesce("found", F.lit(0))).alias("n_links"), F.coalesce("component_id", "least_id").alias("component_id"), F.col("copies").alias("_n"))
    return _answer(attach(rows.where("x IS NOT NULL").select("vec_id", "h1", "h2"), materialise(known, "known"), ["h1", "h2"]).select("vec_id", "n_links", "component_id").unionByName(alone))


def _answer(rows: DataFrame) -> DataFrame:
    return rows.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
