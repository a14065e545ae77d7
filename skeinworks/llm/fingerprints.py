"""Document fingerprints: the wide digest of a canonical text, checked byte for byte.

The canonical text has compatibility-normalised characters, folded case and single spaces. Equal
digests are confirmed by comparing canonical bytes inside each bucket (least against greatest, which
pre-aggregates, so a bucket of any size is never held in one place). A digest whose bucket holds
different bytes gets the SHA-256 of the bytes appended, so fingerprints stay exact.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinworks.llm._common import batch_of, batches, marked_places, partitions, ready, spread

#: Bits of the fixed-size table of digests that occur more than once.
SHARED_BITS = 1 << 23
#: Ranges of ids for each shuffle partition, so that hashed ranges fill partitions evenly.
RANGES_PER_PARTITION = 4
NULL_ID = -(1 << 63)


def canonical(text: str) -> str:
    folded = text.lower() if text.isascii() else unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    return " ".join(folded.split())


def digest(data: bytes) -> str:
    return xxhash.xxh3_128_hexdigest(data)


def likeness(a: bytes, b: bytes, da: str, db: str) -> float:
    """1 for equal digests of equal bytes, else 0: an exact digest knows no nearness in between."""
    return float(da == db and a == b)


def _texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(docs[id_column].cast("long").alias("doc_id"), F.coalesce(docs[text_column].cast("string"), F.lit("")).alias("text"))


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` per input row; null text is empty, null ids stay, an empty table gives none."""
    ready(docs)
    rows = spread(_texts(docs, id_column, text_column))
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.string()), ("wide", pa.string())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            data = [canonical(t).encode() for t in batch.column(1).to_pylist()]
            yield batch_of(schema, batch.column(0), [digest(d) for d in data], [hashlib.sha256(d).hexdigest() for d in data])

    return resolved(rows.mapInArrow(run, "doc_id long, fingerprint string, wide string"), colliding(rows), ("fingerprint", "wide")).drop("wide")


def groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``fingerprint, first_id, copies``: the classes of equal canonical texts, whatever their size."""
    return fingerprints(docs, id_column, text_column).groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))


def colliding(rows: DataFrame) -> DataFrame:
    """Digests whose bucket holds different canonical bytes (in all likelihood none)."""

    def digests(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("fingerprint", pa.string()), ("bit", pa.int64())])
        for batch in batches(it):
            found = [digest(canonical(t).encode()) for t in batch.column(1).to_pylist()]
            yield batch_of(schema, found, [int(d[:8], 16) % SHARED_BITS for d in found])

    several = rows.mapInArrow(digests, "fingerprint string, bit long").groupBy("fingerprint", "bit").count().where("count > 1")
    shared = marked_places(several.select("bit"), SHARED_BITS)

    def members(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("fingerprint", pa.string()), ("data", pa.binary())])
        for batch in batches(it):
            data = [canonical(t).encode() for t in batch.column(1).to_pylist()]
            found = [(d, x) for x in data for d in [digest(x)] if shared[int(d[:8], 16) % SHARED_BITS]]
            if found:
                yield batch_of(schema, *zip(*found, strict=True))

    bounds = rows.mapInArrow(members, "fingerprint string, data binary").groupBy("fingerprint").agg(F.min("data").alias("least"), F.max("data").alias("greatest"))
    return bounds.where("least < greatest").select("fingerprint")


def resolved(rows: DataFrame, collided: DataFrame, *columns: tuple[str, str]) -> DataFrame:
    """Appends the wide digest to fingerprints that stand for different texts. ``columns``: fingerprint and its wide digest."""
    if not collided.limit(1).collect():
        return rows
    for fingerprint, wide in columns:
        other = collided.select(F.col("fingerprint").alias("_collided"))
        rows = rows.join(other, rows[fingerprint] == other["_collided"], "left")
        rows = rows.withColumn(fingerprint, F.when(F.col("_collided").isNotNull(), F.concat_ws(":", fingerprint, wide)).otherwise(F.col(fingerprint))).drop("_collided")
    return rows


EDITED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, wide string, edited_wide string"
EDITED_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("wide", pa.string()), ("edited_wide", pa.string())])


def _edited(doc_id: int | None, text: str, following: str) -> tuple:
    half = len(text) // 2
    edited = text[: len(text) - half] + following[:half]
    own, other, after = (canonical(t).encode() for t in (text, edited, following))
    d, e = digest(own), digest(other)
    return doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), d, e, likeness(own, other, d, e), likeness(own, after, d, digest(after)), hashlib.sha256(own).hexdigest(), hashlib.sha256(other).hexdigest()


def edited_fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Each text's fingerprint beside that of the text whose last half is replaced by the next document's first characters.

    The next document is that of the next smaller id, after the last the first. Repeated ids go by
    text; null ids come last and stay null; null text is empty; an empty table gives none; other
    columns are ignored.

    Rows are dealt out by ranges of the id. The first row of a range also goes to the range before it
    as a guest, so each task finds every next document beside its own and holds two texts at a time.
    """
    spark = ready(docs)
    n = partitions(spark)
    rows = _texts(docs, id_column, text_column)
    key = F.coalesce("doc_id", F.lit(NULL_ID))
    ranges = n * RANGES_PER_PARTITION
    cuts = rows.agg(F.percentile_approx(key, [i / ranges for i in range(1, ranges)], F.lit(10 * ranges)).alias("cuts")).first().cuts or []
    cuts = F.array(*(F.lit(c) for c in sorted(set(cuts)))).cast("array<long>")
    keyed = rows.withColumn("key", key).withColumn("own", F.size(F.filter(cuts, lambda c: c >= F.col("key"))))
    heads = sorted((r.own, r.head) for r in keyed.groupBy("own").agg(F.max("key").alias("head")).collect())  # one row for each range
    guests = spark.createDataFrame([(head, heads[i - 1][0]) for i, (_, head) in enumerate(heads)], "key long, guest int")
    placed = keyed.join(F.broadcast(guests), "key", "left").select(
        "doc_id", "key", "text", F.explode(F.when(F.col("guest").isNull(), F.array(F.struct(F.col("own").alias("place"), F.lit(0).alias("visit")))).otherwise(F.array(F.struct(F.col("own").alias("place"), F.lit(0).alias("visit")), F.struct(F.col("guest").alias("place"), F.lit(1).alias("visit"))))).alias("at")
    )
    dealt = placed.select("doc_id", "key", "text", "at.place", "at.visit").repartition(n, "place").sortWithinPartitions("place", "visit", F.desc("key"), "text")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out = None, []  # held: id, text and range of the row whose next document has not come yet
        for batch in batches(it):
            for doc_id, text, place, visit in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4)), strict=True):
                if held is not None and held[2] == place:
                    out.append(_edited(held[0], held[1], text))
                    held = None
                if not visit:
                    held = (doc_id, text, place)
            if out:
                yield batch_of(EDITED_SCHEMA, *zip(*out, strict=True))
                out = []

    found = dealt.mapInArrow(run, EDITED)
    return resolved(found, colliding(spread(rows)), ("fingerprint", "wide"), ("edited_fingerprint", "edited_wide")).drop("wide", "edited_wide")
