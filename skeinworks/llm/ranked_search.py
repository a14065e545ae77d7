"""Ranked lexical search over compressed postings: document at a time, by a k-way heap merge.

A task cuts its documents into shards of a bounded number of term occurrences and writes, for each
term of a shard, its postings: gaps of document numbers and occurrences as variable-length integers,
in order of doc_id. Nothing is shuffled for that. A search takes the postings of its terms to the
tasks of their shards. There a heap of cursors yields one document after the other; terms whose
largest scores together cannot reach the k-th score so far have no cursor and are only looked up. The
result heap of a query holds k documents, keyed by score and then doc_id, and goes on from shard to
shard; the heaps of all tasks are merged at the end.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush, heapreplace
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skeinworks.llm._common import batches, materialise, partitions, ready, spread

#: Term occurrences of a shard; bytes of a text that are cut into terms at a time; distinct terms of a block of queries.
SHARD_TERMS, SLICE, BLOCK_TERMS = 1 << 22, 4 << 20, 1 << 16
#: What is no letter or digit of ASCII, and no other character beyond ASCII, is a blank; only A-Z are lower-cased.
_AS_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The text's terms in order, a bounded stretch at a time."""
    data = (text or "").encode().translate(_AS_TERMS)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + SLICE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


# ---- variable-length integers


def varints(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of non-negative numbers, seven bits in each, the lowest first; and how many bytes each takes."""
    x = x.astype(np.uint64)
    size = np.ones(len(x), np.int64)
    for k in range(1, 10):
        size += x >= np.uint64(1 << 7 * k)
    first = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    for k in range(int(size.max(initial=0))):
        on = size > k
        out[first[on] + k] = ((x[on] >> np.uint64(7 * k)) & np.uint64(127)).astype(np.uint8) | ((size[on] > k + 1) * np.uint8(128))
    return out, size


def numbers(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    last = np.flatnonzero(raw < 128)
    if not len(last):
        return np.zeros(0, np.int64)
    first = np.concatenate([[0], last[:-1] + 1])
    shift = (np.arange(len(raw)) - np.repeat(first, last - first + 1)) * 7
    return np.add.reduceat((raw & 127).astype(np.uint64) << shift.astype(np.uint64), first).astype(np.int64)


def folded(x: np.ndarray) -> np.ndarray:
    """Signed numbers as non-negative ones: 0, -1, 1, -2, ... as 0, 1, 2, 3, ..."""
    return ((x << 1) ^ (x >> 63)).view(np.uint64)


def unfolded(x: np.ndarray) -> np.ndarray:
    return (x.view(np.uint64) >> np.uint64(1)).astype(np.int64) ^ -(x & 1)


# ---- the index

ROW = pa.schema([("shard", pa.int64()), ("term", pa.string()), ("df", pa.int64()), ("total", pa.int64()), ("postings", pa.binary())])
ROW_DDL = "shard long, term string, df long, total long, postings binary"


class Shard:
    """Documents of one shard while it is built. Only those with a term are kept."""

    def __init__(self) -> None:
        self.words: defaultdict[bytes, int] = defaultdict()
        self.words.default_factory = self.words.__len__
        self.ids: list[int | None] = []
        self.said: list[np.ndarray] = []
        self.size = 0

    def add(self, doc: int | None, text: str | None) -> None:
        found = [np.fromiter(map(self.words.__getitem__, part), np.int32, len(part)) for part in terms(text)]
        said = np.concatenate(found) if found else np.zeros(0, np.int32)
        if len(said):
            self.ids.append(doc)
            self.said.append(said)
            self.size += len(said)

    def rows(self, number: int) -> pa.RecordBatch:
        """A row for each term, and one of the documents (the empty term): doc_ids in order, nulls last, and their lengths."""
        n = len(self.ids)
        order = sorted(range(n), key=lambda i: (self.ids[i] is None, self.ids[i] or 0, len(self.said[i]), self.said[i].tobytes()))
        lengths = np.array([len(self.said[i]) for i in order], np.int64)
        known = np.array([self.ids[i] for i in order if self.ids[i] is not None], np.int64)
        gaps = folded(np.diff(known, prepend=np.int64(0)))  # may wrap around, and back when they are summed up
        documents = varints(np.concatenate([np.array([n, n - len(known)], np.uint64), gaps, lengths.astype(np.uint64)]))[0]
        names = sorted(self.words)
        place = np.empty(len(names), np.int64)
        place[[self.words[w] for w in names]] = np.arange(len(names))
        doc = np.repeat(np.arange(n), lengths)
        code, tf = np.unique(place[np.concatenate([self.said[i] for i in order])] * n + doc, return_counts=True)
        term, doc = code // n, code % n
        df = np.bincount(term, minlength=len(names))
        first = np.cumsum(df) - df
        gap = np.diff(doc, prepend=0)
        gap[first] = doc[first]
        data, size = varints(np.column_stack([gap, tf]).ravel())
        ends = np.cumsum(size.reshape(-1, 2).sum(axis=1))[first + df - 1]
        offsets = np.concatenate([[0, len(documents)], len(documents) + ends]).astype(np.int32)
        postings = pa.Array.from_buffers(pa.binary(), len(names) + 1, [None, pa.py_buffer(offsets), pa.py_buffer(documents.tobytes() + data.tobytes())])
        total = np.concatenate([[lengths.sum()], np.bincount(term, tf, minlength=len(names)).astype(np.int64)])
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(names) + 1, number)), pa.array([b"", *names], pa.binary()).cast(pa.string()), pa.array(np.concatenate([[n], df])), pa.array(total), postings], schema=ROW)


@dataclass
class Index:
    """``rows``: shard, term, df, total, postings. documents: those with a term; occurrences: all their terms with repeats."""

    rows: DataFrame
    documents: int
    occurrences: int


def build(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> Index:
    """The inverted index of whole texts, as a table in the shared folder. Null texts have no terms; null ids stay; repeated rows are documents of their own."""
    ready(docs)
    own = spread(docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].cast("string").alias("text")))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard = TaskContext.get().partitionId() << 32, Shard()
        for batch in batches(it):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                shard.add(doc, text.as_py())
                if shard.size >= SHARD_TERMS:
                    yield from pieces(shard.rows(number))
                    number, shard = number + 1, Shard()
        if shard.size:
            yield from pieces(shard.rows(number))

    rows = materialise(own.mapInArrow(run, ROW_DDL), "postings")
    sums = rows.where("term = ''").agg(F.sum("df").alias("n"), F.sum("total").alias("total")).first()
    return Index(rows, sums.n or 0, sums.total or 0)


def pieces(batch: pa.RecordBatch, most: int = 20_000) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, most):
        yield batch.slice(at, most)


# ---- one shard


def document_lengths(data: bytes) -> tuple[list[int | None], np.ndarray]:
    x = numbers(data)
    n, nulls = int(x[0]), int(x[1])
    known = np.cumsum(unfolded(x[2 : 2 + n - nulls]))
    return [*known.tolist(), *[None] * nulls], x[2 + n - nulls :]


def norms(lengths: np.ndarray, documents: int, occurrences: int) -> np.ndarray:
    """m of each document: 100 - 50 + (50 n N) div L."""
    if int(lengths.max(initial=0)) * 50 * documents < 1 << 63:
        return 50 + 50 * lengths * documents // occurrences
    return np.array([50 + 50 * n * documents // occurrences for n in lengths.tolist()], np.int64)


@dataclass
class Postings:
    """A term's documents in a shard, their shares of the score, the largest, and the k-th largest (0 if there are fewer)."""

    docs: list[int]
    shares: list[int]
    largest: int
    kth: int

    @classmethod
    def read(cls, data: bytes, weight: int, m: np.ndarray, k: int) -> Postings:
        x = numbers(data).reshape(-1, 2)
        doc, tf = np.cumsum(x[:, 0]), x[:, 1]
        share = weight * (1_000_000_000 * tf // (1000 * tf + 20 * m[doc]))
        kth = int(np.partition(share, len(share) - k)[len(share) - k]) if len(share) >= k else 0
        return cls(doc.tolist(), share.tolist(), int(share.max()), kth)


def merge(lists: list[Postings], keys: list[float], heap: list[tuple[int, float]], k: int) -> None:
    """Puts the shard's documents into the heap of the k best ``(score, key)``. Larger keys win ties; documents come in descending order of key.

    Lists in ascending order of their largest share; the first ones, which together stay below the
    least score that still counts, have no cursor: their documents are only looked up.
    """
    lists = sorted((p for p in lists if p.largest > 0), key=lambda p: p.largest)
    docs, shares = [p.docs for p in lists], [p.shares for p in lists]
    together = list(accumulate(p.largest for p in lists))
    least = max([1, *(p.kth for p in lists)])
    if len(heap) == k:
        least = max(least, heap[0][0])
    first, at = 0, [0] * len(lists)
    cursors: list[tuple[int, int]] = []

    def demoted() -> None:
        nonlocal first, cursors
        while first < len(lists) and together[first] < least:
            first += 1
        cursors = [(docs[i][at[i]], i) for i in range(first, len(lists)) if at[i] < len(docs[i])]
        heapify(cursors)

    demoted()
    while cursors:
        doc, score = cursors[0][0], 0
        while cursors and cursors[0][0] == doc:
            i = cursors[0][1]
            score += shares[i][at[i]]
            at[i] += 1
            if at[i] < len(docs[i]):
                heapreplace(cursors, (docs[i][at[i]], i))
            else:
                heappop(cursors)
        i = first - 1
        while i >= 0 and score + together[i] >= least:
            p = at[i] = bisect_left(docs[i], doc, at[i])
            if p < len(docs[i]) and docs[i][p] == doc:
                score += shares[i][p]
            i -= 1
        if i >= 0 or score < least:
            continue
        entry = (score, keys[doc])
        if len(heap) < k:
            heappush(heap, entry)
        elif entry > heap[0]:
            heapreplace(heap, entry)
        if len(heap) == k and heap[0][0] > least:
            least = heap[0][0]
            if first < len(lists) and together[first] < least:
                demoted()


# ---- search


def _blocks(queries: DataFrame, id_column: str, text_column: str) -> Iterator[list[tuple[int | None, list[str]]]]:
    """Queries with their distinct terms, in blocks of a bounded number of terms (a longer query is a block of its own)."""
    own = queries.select(queries[id_column].cast("long").alias("item_id"), queries[text_column].cast("string").alias("text"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            said = [sorted({w.decode() for part in terms(t.as_py()) for w in part}) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(said, pa.list_(pa.string()))], names=["item_id", "terms"])

    block, size = [], 0
    for row in own.mapInArrow(run, "item_id long, terms array<string>").toLocalIterator():
        if block and size + len(row.terms) > BLOCK_TERMS:
            yield block
            block, size = [], 0
        block.append((row.item_id, list(row.terms)))
        size += len(row.terms)
    if block:
        yield block


def _searched(index: Index, block: list[tuple[int | None, list[str]]], first: int, k: int) -> DataFrame:
    """``item, item_id, doc_id, score``: the k best documents of each task for each query of the block."""
    spark = index.rows.sparkSession
    wanted = spark.createDataFrame([(t,) for t in sorted({t for _, said in block for t in said})], "term string")  # BLOCK_TERMS, or one query's
    found = index.rows.join(F.broadcast(wanted), "term", "left_semi")
    # A term in one document of 2^63 has a weight; one in nearly all of few documents may have none.
    weight = F.floor(1000 * F.log((2.0 * F.lit(index.documents) + 2) / (2.0 * F.sum("df") + 1))).cast("long")
    weights = {r.term: r.w for r in found.groupBy("term").agg(weight.alias("w")).collect() if r.w > 0}
    asked = [[t for t in said if t in weights] for _, said in block]
    documents, occurrences = index.documents, index.occurrences
    held = index.rows.join(F.broadcast(wanted.union(spark.createDataFrame([("",)], "term string"))), "term", "left_semi").select("shard", "term", "postings")
    dealt = held.repartition(partitions(spark), "shard").sortWithinPartitions("shard", "term")
    schema = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: list[list[tuple[int, float]]] = [[] for _ in asked]
        now, m, keys, read = None, np.zeros(0, np.int64), [], {}

        def search() -> None:
            for heap, said in zip(heaps, asked, strict=True):
                if lists := [read[t] for t in said if t in read]:
                    merge(lists, keys, heap, k)

        for batch in batches(it):
            for shard, term, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if shard != now:
                    search()
                    now, read = shard, {}
                if term == "":
                    ids, lengths = document_lengths(data)
                    keys = [float("-inf") if i is None else -i for i in ids]
                    m = norms(lengths, documents, occurrences)
                elif term in weights:
                    read[term] = Postings.read(data, weights[term], m, k)
        search()
        rows = [(first + i, None if key == float("-inf") else -key, score) for i, heap in enumerate(heaps) for score, key in heap]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    items = spark.createDataFrame([(first + i, item) for i, (item, _) in enumerate(block)], "item long, item_id long")
    return dealt.mapInArrow(run, "item long, doc_id long, score long").join(F.broadcast(items), "item")


def search(index: Index, queries: DataFrame, k: int = 50, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: each query's k best documents with a score above 0, ties to the smaller doc_id.

    A query's terms count once. Queries without a known term give no row; repeated queries are asked
    each by itself; null query ids stay; documents with a null id rank after all others of the same
    score; repeated documents are results of their own; an empty index or table of queries gives no
    row. Texts may be of any length; other columns are ignored.
    """
    spark = ready(queries)
    found, first = None, 0
    for n, block in enumerate(_blocks(queries, id_column, text_column)):
        if not index.documents or not any(said for _, said in block):
            continue
        got = _searched(index, block, first, k)
        first += len(block)
        if n >= 8:
            got = materialise(got, "ranked")  # keeps the plan short
        found = got if found is None else found.unionByName(got)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
