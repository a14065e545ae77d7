"""What the operators of this subpackage share: batches, partitions and fixed-size tables."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinworks.session import ARROW_BYTES, BATCH_ROWS, materialise, shared_dir, ship, short_batches  # noqa: F401

def ready(df: DataFrame) -> SparkSession:
    """The session of ``df``, with this package on the workers' path and short Arrow batches."""
    return short_batches(ship(df.sparkSession))


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out anew if the input has fewer partitions than the cluster has cores (small or unsplittable files)."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column's strings, null as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def crc_mod(column: str, m: int):
    """crc32 of the id written as text, modulo m, as a DataFrame column."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % m


def bounded_sample(df: DataFrame, key: str, limit: int) -> DataFrame:
    """At most ``limit`` distinct rows, those with the least hash of ``key``: the same rows on every run and partitioning.

    Select the columns needed first. A share of the rows that fits the limit is taken by hash before
    the sort, so what meets in one place follows the limit and not the table.
    """
    rows = df.count()
    share = min(1.0, 2.0 * limit / max(rows, 1))
    order = F.pmod(F.xxhash64(F.col(key), F.lit(17)), F.lit(1 << 31))
    return df.where(order < int(share * (1 << 31))).distinct().orderBy(order, F.col(key)).limit(limit)


def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        if batch.num_rows:
            yield batch


#: Bits of a fixed-size table of ids: 1 MB, whatever the number of ids.
ID_BITS = 1 << 23


def id_place(column: str):
    """The place of an id in such a table."""
    return F.pmod(F.xxhash64(F.col(column)), F.lit(ID_BITS))


def id_table(ids: DataFrame, column: str) -> np.ndarray:
    """Which of ID_BITS places the hashes of the ids fall on, gathered as at most ID_BITS / 32 rows.

    A reader that keeps only rows on marked places loses none of the ids; what else falls on them is
    sorted out by a join afterwards, which then moves little more than the rows wanted.
    """
    return marked_places(ids.select(id_place(column).alias("bit")), ID_BITS)


def marked_places(places: DataFrame, bits: int) -> np.ndarray:
    """The places in column ``bit`` as a table of ``bits`` booleans: at most bits / 32 rows of two numbers reach the driver, as Arrow."""
    words = places.select((F.col("bit") / 32).cast("long").alias("word"), F.expr("shiftleft(1L, CAST(bit % 32 AS INT))").alias("bits"))
    got = words.groupBy("word").agg(F.expr("bit_or(bits)").alias("bits")).toArrow()
    table = np.zeros(bits // 32, np.uint32)
    table[got.column("word").to_numpy()] = got.column("bits").to_numpy().astype(np.uint32)
    return np.unpackbits(table.view(np.uint8), bitorder="little").view(bool)


#: A key with more than one in so many rows is frequent: there are that many such keys at most, whatever the table.
FREQUENT = 1024


def attach(rows: DataFrame, found: DataFrame, keys: list[str], count: str = "_n") -> DataFrame:
    """Rows with the columns that ``found`` (a written table) has for their keys; null keys are equal; rows without a match are left out.

    ``found`` has one row for each key, with the number of its rows in ``count``. Frequent keys are
    joined by broadcast (at most FREQUENT rows), so that a hot one stays where its rows are; the others
    are shuffled. Key columns of ``found`` are dropped.
    """
    total = found.agg(F.sum(count).alias("n")).first().n or 0
    found = found.select(*(F.col(k).alias(f"_k_{k}") for k in keys), *(c for c in found.columns if c not in (*keys,)))
    often = found.where(F.col(count) * FREQUENT > total)
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    drop = [*(f"_k_{k}" for k in keys), count]
    hot = rows.join(F.broadcast(often), same, "inner")
    rest = rows.join(F.broadcast(often), same, "left_anti").join(found.where(F.col(count) * FREQUENT <= total), same, "inner")
    return hot.drop(*drop).unionByName(rest.drop(*drop))


def give_back() -> None:
    """Has the C library return what a fit has used; the driver's process goes on for long. Without that call nothing is done."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def on_table(df: DataFrame, column: str, table: np.ndarray, hit: bool = True) -> DataFrame:
    """The rows whose id falls on the table (or does not), all columns as they are."""
    packed, schema, last = np.packbits(table).tobytes(), df.schema, len(df.columns)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.unpackbits(np.frombuffer(packed, np.uint8)).astype(bool)
        for batch in batches(it):
            keep = marked[batch.column(last).to_numpy()] == hit
            if keep.any():
                yield batch.select(range(last)).filter(pa.array(keep))

    return df.select("*", id_place(column).alias("_place")).mapInArrow(run, schema)
