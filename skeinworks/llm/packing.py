"""Lexical retrieval packing: sequences of a fixed length, filled with lexical neighbours.

Documents are tokenised once into a table in the shared folder: digests of their full windows, and
the ids of the rest. Rests are dealt out by their most telling ids (rare ones of the vocabulary that
occur often) into shards of bounded size; an id breaks ties, so a hot vocabulary is split. Each shard
has a BM25 inverted index, weighted by the frequencies and the mean length of all rests: a seed's most
telling ids are looked up, and its unused neighbours fill the window in order of score; the last gap
is filled by cutting the best neighbour that did not fit. A window that is not full when a seed's
neighbours are used up goes on with those of its last document. Only the last window of a shard is
short. Neighbours in other shards are not looked for: that would take each seed to every shard, work
that grows with the square of the input.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinworks.llm._common import batch_of, batches, materialise, ready, spread
from skeinworks.llm.token_counts import balanced, encoder

#: Documents of a shard (a mean), and most in one index (a bound).
SHARD_DOCS, INDEX_DOCS = 4096, 8192
#: BM25's constants; ids of a seed that are looked up; neighbours tried for a window.
K1, B, QUERY_IDS, NEIGHBOURS = 1.2, 0.75, 16, 24


@dataclass
class Rest:
    """What is left of a document after its full windows."""

    doc: int | None
    tokens: int
    start: int
    ids: np.ndarray


@dataclass
class Corpus:
    """Of all rests: how many there are, their mean length, and how many have each id."""

    n: int
    mean: float
    df: np.ndarray


def corpus_of(lists: Iterable[np.ndarray], vocabulary: int) -> Corpus:
    n, total, df = 0, 0, np.zeros(vocabulary, np.int64)
    for ids in lists:
        if len(ids):
            n, total = n + 1, total + len(ids)
            df[np.unique(ids)] += 1
    return Corpus(n, total / max(n, 1), df)


class Index:
    """BM25 over the rests' ids; ``near`` ranks unused rests for a seed. Without ``corpus`` the rests are all there are."""

    def __init__(self, rests: list[Rest], vocabulary: int, corpus: Corpus | None = None):
        n, lengths = len(rests), np.array([len(r.ids) for r in rests])
        doc = np.repeat(np.arange(n), lengths)
        term = np.concatenate([r.ids for r in rests]).astype(np.int64) if n else np.zeros(0, np.int64)
        pair, tf = np.unique(term * max(n, 1) + doc, return_counts=True)
        self.term, self.doc = pair // max(n, 1), (pair % max(n, 1)).astype(np.int64)
        df = np.bincount(self.term, minlength=vocabulary)
        corpus = corpus or Corpus(n, lengths.mean() if n else 1, df)
        every = np.pad(corpus.df, (0, len(df) - len(corpus.df)))
        idf = np.log1p((corpus.n - every + 0.5) / (every + 0.5))
        norm = K1 * (1 - B + B * lengths / max(corpus.mean, 1))
        self.weight = idf[self.term] * tf * (K1 + 1) / (tf + norm[self.doc])
        self.first = np.concatenate([[0], np.cumsum(df)])
        # A seed's most telling ids, best first: those of the highest weight that another rest has too.
        shared = df[self.term] > 1
        order = np.lexsort((self.term[shared], -self.weight[shared], self.doc[shared]))
        self.by_doc = self.term[shared][order]
        self.at = np.searchsorted(self.doc[shared][order], np.arange(n + 1))
        self.n = n

    def near(self, seed: int, used: np.ndarray) -> np.ndarray:
        terms = self.by_doc[self.at[seed] : min(self.at[seed] + QUERY_IDS, self.at[seed + 1])]
        if not len(terms):
            return terms
        spans = [slice(self.first[t], self.first[t + 1]) for t in terms]
        scores = np.bincount(np.concatenate([self.doc[s] for s in spans]), np.concatenate([self.weight[s] for s in spans]), minlength=self.n)
        scores[used] = 0
        best = np.argpartition(-scores, min(NEIGHBOURS, self.n - 1))[:NEIGHBOURS]
        best = best[scores[best] > 0]
        return best[np.lexsort((best, -scores[best]))]


def fill(rests: list[Rest], length: int, vocabulary: int, corpus: Corpus | None = None) -> Iterator[list[tuple[int, int, int]]]:
    """Windows as lists of (rest, first id, number of ids). All are full but the last."""
    index = Index(rests, vocabulary, corpus)
    used = np.array([not len(r.ids) for r in rests], dtype=bool)
    begun = [0] * len(rests)
    seeds, pending = iter(range(len(rests))), None

    def following() -> int | None:
        return next((s for s in seeds if not used[s]), None)

    while True:
        seed = pending if pending is not None else following()
        if seed is None:
            return
        pending = None
        room = length
        window: list[tuple[int, int, int]] = []

        def take(i: int) -> None:
            """The rest, or as much of it as there is room for; what is left begins the next window."""
            nonlocal room, pending
            n = min(room, len(rests[i].ids) - begun[i])
            window.append((i, begun[i], n))
            begun[i] += n
            room -= n
            used[i] = True
            pending = i if begun[i] < len(rests[i].ids) else pending

        take(seed)
        asked = seed
        while room:
            near = [i for i in index.near(asked, used).tolist() if not used[i]]
            for i in near:
                if room and len(rests[i].ids) <= room:
                    take(i)
            for i in near:
                if room and not used[i]:
                    take(i)
            if not near:
                if (following_one := following()) is None:
                    break
                take(following_one)
            asked = window[-1][0]
        yield window


TOKENISED = pa.schema([("doc_id", pa.int64()), ("doc_tokens", pa.int64()), ("sketch", pa.int64()), ("crcs", pa.list_(pa.int64())), ("rest", pa.binary())])
FREQUENCIES = pa.schema([(n, pa.int64()) for n in ("id", "df", "total")])
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def telling(ids: np.ndarray) -> int:
    """The three most telling ids as one number: a vocabulary numbers rare tokens last, and repeated ones weigh more."""
    found, tf = np.unique(ids, return_counts=True)
    best = found[np.lexsort((found, -(tf / (tf + K1) * found.astype(float) ** 2)))[:3]].tolist()
    return sum(i << shift for i, shift in zip(best, (42, 21, 0), strict=False))


def tokenised(docs: DataFrame, path: str, length: int, end_id: int) -> DataFrame:
    rows = spread(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        small = enc.core.n_vocab <= 1 << 16
        for docs_, texts in balanced(it, 4 << 20):
            every, bounds = enc.encode_many(texts)
            out = []
            for doc, a, b in zip(docs_, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                ids = np.append(every[a:b], end_id).astype("<u4")
                full = len(ids) // length * length
                rest = ids[full:]
                out.append((doc, len(ids), telling(rest[:-1]), [crc32(ids[i : i + length].tobytes()) for i in range(0, full, length)], (rest.astype("<u2") if small else rest).tobytes()))
            yield batch_of(TOKENISED, *zip(*out, strict=True))

    return rows.mapInArrow(run, "doc_id long, doc_tokens long, sketch long, crcs array<long>, rest binary")


def measured(table: DataFrame, path: str) -> Corpus:
    """Sums over the tokenised table; what meets in the driver has a row for each id of the vocabulary and one more."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, kind = size_and_kind(path)
        found = corpus_of((np.frombuffer(r, kind) for batch in batches(it) for r in batch.column(0).to_pylist()), vocabulary)
        at = np.flatnonzero(found.df)
        yield batch_of(FREQUENCIES, [*at.tolist(), -1], [*found.df[at].tolist(), found.n], [*np.zeros(len(at), np.int64).tolist(), round(found.mean * found.n)])

    sums = table.select("rest").mapInArrow(run, "id long, df long, total long").groupBy("id").agg(F.sum("df").alias("df"), F.sum("total").alias("total")).collect()
    df = np.zeros(max((r.id + 1 for r in sums), default=0), np.int64)
    n, total = next(((r.df, r.total) for r in sums if r.id < 0), (0, 0))
    for r in sums:
        if r.id >= 0:
            df[r.id] = r.df
    return Corpus(n, total / max(n, 1), df)


def size_and_kind(path: str) -> tuple[int, str]:
    """Ids there are, the end included, and how a rest's ids are written."""
    size = encoder(path).core.n_vocab
    return size + 1, "<u2" if size <= 1 << 16 else "<u4"


def pack(docs: DataFrame, path: str, length: int = 1024, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Pieces of documents in sequences of ``length`` ids: where each piece begins in its document and its sequence.

    ``with_ids`` adds the ids of pieces cut from rests (a full window's ids are those of its document
    from ``start``). Null text is empty: its one id is ``end_id``. Null ids stay; repeated rows are
    documents of their own; an empty table gives no piece; other columns are ignored.
    """
    ready(docs)
    table = materialise(tokenised(docs, path, length, end_id), "tokenised")
    corpus = measured(table, path)
    shards = max(1, -(-table.count() // SHARD_DOCS))
    # A tokenised row is never altered, so a lost executor's shard is packed again in the same way.
    dealt = table.repartitionByRange(shards, "sketch", "doc_id", "doc_tokens").sortWithinPartitions("sketch", "doc_id", "doc_tokens", F.crc32("rest"))
    schema = pa.schema([*((n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")), *([("ids", pa.binary())] if with_ids else [])])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, kind = size_and_kind(path)
        sequence = TaskContext.get().partitionId() << 32
        rests: list[Rest] = []

        def packed() -> pa.RecordBatch:
            nonlocal sequence
            out = []
            for window in fill(rests, length, vocabulary, corpus):
                offset = 0
                for i, begin, n in window:
                    r = rests[i]
                    data = r.ids[begin : begin + n].astype("<u4").tobytes()
                    out.append((r.doc, r.start + begin, n, crc32(data), r.tokens, sequence, offset, *([data] if with_ids else [])))
                    offset += n
                sequence += 1
            return batch_of(schema, *zip(*out, strict=True))

        for batch in batches(it):
            out = []
            for doc, tokens, crcs, rest in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4)), strict=True):
                for k, crc in enumerate(crcs):
                    out.append((doc, k * length, length, crc, tokens, sequence, 0, *([None] if with_ids else [])))
                    sequence += 1
                if rest:
                    rests.append(Rest(doc, tokens, len(crcs) * length, np.frombuffer(rest, kind)))
            if out:
                yield batch_of(schema, *zip(*out, strict=True))
            if len(rests) >= INDEX_DOCS:
                yield packed()
                rests = []
        if rests:
            yield packed()

    return dealt.mapInArrow(run, PIECES + (", ids binary" if with_ids else ""))
