"""N-gram Jaccard join: a size-aware heavy-light join of word-shingle sets, and its components.

Equal sets are one class from the start. Sets below a size boundary are *light*: all subsets that a
partner's intersection may be are enumerated as digests, and sets that share one are paired through
the bucket's smallest set, which is exact and never pairs a bucket with itself. Larger sets are
*heavy*: their least frequent shingles (as many as a partner must share one of) go to inverted
lists, and list members that pass the size and place bounds are paired. All pairs are verified on
their whole sets. The boundary is where the cost of enumerating and of scanning, by the histogram of
sizes, is least.

Shingles are ordered by a fixed-size count sketch of the whole input (rare first, then by digest).
Any order gives the same links; this one keeps shingles of shared passages out of the lists. A long
list is first linked through a few likely pairs of each member, and only members of different
components meet again, block by block, so no task holds a list. Shingles are 64-bit digests, compared
within a pair only; sets are told apart by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinworks.llm._common import ARROW_BYTES, batch_of, batches, give_back, id_place, id_table, materialise, on_table, partitions, ready, spread
from skeinworks.llm.token_counts import balanced
from skeinworks.operators.components import connected_components

#: Counters of the sketch (fixed) and of a block of it that travels as one row.
COUNTERS, BLOCK = 1 << 22, 1 << 16
#: Cost of a list entry, with what verifying takes, against that of an enumerated subset; sizes considered for the boundary.
SCAN_COST, LARGEST_LIGHT = 12, 40
#: Characters of texts that are shingled at a time: their words, digests and sets take some thirty times as many bytes.
BATCH_CHARS = 2 << 20
#: Lists up to this length are paired at once; shingles that the sketch counts more often are dealt out by set, not by shingle.
SHORT_LIST, LONG_LIST = 16, 4096
#: Members of a long list that meet as a block, at least, and of very long ones at most: a list is sent once for each of its blocks. Partners of a set that are verified beside one copy of it.
LIST_BLOCK, LARGEST_BLOCK, PARTNERS = 256, 4096, 64
#: Parts of a set's profile, which bounds intersections.
PARTS = 128
ABSENT = (1 << 63) - 1  # stands for a null id: never the least

# Odd 64-bit constants of the mixing steps.
_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX[1]
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX[2]
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """Sorted distinct digests of each text's shingles. Words lie between ASCII white space; A-Z are folded."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.large_string())))
    coded = lists.flatten().dictionary_encode()
    index, distinct = coded.indices.to_numpy(), coded.dictionary.to_pylist()
    digests = np.array([xxhash.xxh3_64_intdigest(w) for w in distinct], dtype=np.uint64)
    full = np.array([bool(w) for w in distinct], dtype=bool)[index]
    bounds = np.concatenate([[0], np.cumsum(full)])[lists.offsets.to_numpy()]
    word = digests[index[full]]
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(len(word) - words + 1, 0), dtype=np.uint64)
        for k in range(words):
            rolled = mixed(rolled * _MIX[0] + word[k : k + len(rolled)] + np.uint64(k))
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(rolled[a : b - words + 1]))
        elif b > a:
            out.append(np.array([xxhash.xxh3_64_intdigest(word[a:b].tobytes(), seed=b - a)], dtype=np.uint64))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def class_keys(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit digests of a set."""
    both = xxhash.xxh3_128_intdigest(s.tobytes())
    return (both & ((1 << 64) - 1)) - (1 << 63), (both >> 64) - (1 << 63)


def class_key(s: np.ndarray, clashing: frozenset[int] = frozenset()) -> int:
    """The first digest, or the second where the first is that of several sets."""
    first, second = class_keys(s)
    return second if first in clashing else first


def profile(s: np.ndarray) -> bytes:
    """How many members fall into each of PARTS parts of the digests, up to 255."""
    return np.minimum(np.bincount((s >> np.uint64(20)).astype(np.int64) % PARTS, minlength=PARTS), 255).astype(np.uint8).tobytes()


def spare(size: int, percent: int) -> int:
    """Most shingles of a set of this size that a partner may lack."""
    return size * (100 - percent) // 100


def overlap(a: int, b: int, percent: int) -> int:
    """Least intersection of linked sets of these sizes: 100 i >= percent (a + b - i)."""
    return -(-percent * (a + b) // (100 + percent))


def boundary(sizes: dict[int, int], percent: int) -> int:
    """Sets below this size are light. ``sizes``: how many sets there are of each small size."""

    def cost(x: int) -> int:
        light = sum(n * sum(comb(s, j) for j in range(spare(s, percent) + 1)) for s, n in sizes.items() if s < x)
        scanned = sum(n * (spare(s, percent) + 1) * SCAN_COST for s, n in sizes.items() if 100 * s >= percent * x)
        return light + scanned

    return min(range(1, LARGEST_LIGHT + 1), key=lambda x: (cost(x), x))


def subsets(s: np.ndarray, lacking: int) -> Iterator[tuple[int, int]]:
    """(digest, size) of all subsets that lack at most so many members. A subset's digest is the sum of its members'."""
    with np.errstate(over="ignore"):
        parts = mixed(s + _MIX[0])
        sums = np.array([parts.sum(dtype=np.uint64)])
        last = np.array([-1])
        for j in range(lacking + 1):
            for x in sums.tolist():
                yield x - (1 << 63), len(s) - j
            grown = [(sums[k] - parts[last[k] + 1 :], np.arange(last[k] + 1, len(s))) for k in range(len(sums))] if j < lacking else []
            sums = np.concatenate([g for g, _ in grown]) if grown else sums
            last = np.concatenate([i for _, i in grown]) if grown else last


_ROWS = "doc_id long, n_shingles int, key long, second long, profile binary, block int, counts binary"
_ROWS_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int32()), ("key", pa.int64()), ("second", pa.int64()), ("profile", pa.binary()), ("block", pa.int32()), ("counts", pa.binary())])
#: share: the size of a light set's subset; 0 for a list's shingle; LONG for one of a list that is surely or possibly long.
_ENTRIES = "token long, share int, size int, key long, place int"
_ENTRIES_SCHEMA = pa.schema([("token", pa.int64()), ("share", pa.int32()), ("size", pa.int32()), ("key", pa.int64()), ("place", pa.int32())])
LONG = -1
#: kind 1: a pair to verify; 2: a member of a long list (b: unused).
_FOUND = "kind int, a long, a_size int, b long, b_size int, token long, place int"
_FOUND_SCHEMA = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("a_size", pa.int32()), ("b", pa.int64()), ("b_size", pa.int32()), ("token", pa.int64()), ("place", pa.int32())])
_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].cast("string").alias("text"))


def _measured(rows: DataFrame, words: int) -> DataFrame:
    """A row per document, and each task's share of the count sketch in blocks."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, dtype=np.uint32)
        for ids, texts in balanced(it, BATCH_CHARS):
            sets = shingle_sets(texts, words)
            place, n = np.unique((np.concatenate(sets) >> np.uint64(42)).astype(np.uint32), return_counts=True)
            counts[place] += n.astype(np.uint32)
            n, keys = len(ids), [class_keys(s) for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int32()), *(pa.array([k[i] for k in keys], pa.int64()) for i in (0, 1)), pa.array([profile(s) for s in sets], pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], schema=_ROWS_SCHEMA)
        if counts.any():
            kept = [(b, block.astype("<u4").tobytes()) for b, block in enumerate(counts.reshape(-1, BLOCK)) if block.any()]
            n = len(kept)
            yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array([b for b, _ in kept], pa.int32()), pa.array([c for _, c in kept], pa.binary())], schema=_ROWS_SCHEMA)

    return rows.mapInArrow(run, _ROWS)


def _frequent(measured: DataFrame) -> tuple[bytes, bytes]:
    """Which counters of the sketch stand out of its mean, and which exceed LONG_LIST: two fixed-size tables of bits."""
    schema = pa.schema([("block", pa.int32()), ("counts", pa.binary())])

    def add(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches(it):
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[block] = total.get(block, 0) + np.frombuffer(counts, "<u4").astype("<i8")
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], schema=schema)

    spark = measured.sparkSession
    blocks = measured.where("block IS NOT NULL").select("block", "counts")
    summed = blocks.repartition(min(partitions(spark), COUNTERS // BLOCK), "block").mapInArrow(add, "block int, counts binary")
    counts = np.zeros((COUNTERS // BLOCK, BLOCK), dtype=np.int64)
    got = summed.toArrow()  # one row for each block: 32 MB in all
    for block, data in zip(got.column("block").to_pylist(), got.column("counts"), strict=True):
        counts[block] += np.frombuffer(data.as_buffer(), "<i8")
    del got
    counts = counts.ravel()
    mean = counts.mean()
    tables = np.packbits(counts > mean + 4 * mean**0.5 + 4).tobytes(), np.packbits(counts > LONG_LIST).tobytes()
    del counts
    give_back()
    return tables


def _entries(rows: DataFrame, words: int, percent: int, light: int, frequent: tuple[bytes, bytes], clashing: frozenset[int]) -> DataFrame:
    """Subsets of light sets and rare shingles of sets that may meet a heavy one."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, long = (np.unpackbits(np.frombuffer(x, np.uint8)).view(bool) for x in frequent)
        seen: set[int] = set()
        for _, texts in balanced(it, BATCH_CHARS):
            cols: list[list[np.ndarray]] = [[], [], [], [], []]

            def put(tokens: np.ndarray, share: np.ndarray | int, size: int, key: int) -> None:
                n = len(tokens)
                for col, x in zip(cols, (tokens, np.full(n, share) if isinstance(share, int) else share, np.full(n, size), np.full(n, key, dtype=np.int64), np.arange(n)), strict=True):
                    col.append(x)

            for s in shingle_sets(texts, words):
                size = len(s)
                if not size or (key := class_key(s, clashing)) in seen:
                    continue
                seen.add(key)
                if size < light:
                    got = list(subsets(s, spare(size, percent)))
                    put(np.array([x for x, _ in got], dtype=np.int64), np.array([c for _, c in got]), size, key)
                if 100 * size >= percent * light:
                    late = common[(s >> np.uint64(42)).astype(np.int64)]
                    chosen = np.concatenate([s[~late], s[late]])[: spare(size, percent) + 1]
                    put(chosen.view(np.int64), np.where(long[(chosen >> np.uint64(42)).astype(np.int64)], LONG, 0), size, key)
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), type=f.type) for c, f in zip(cols, _ENTRIES_SCHEMA, strict=True)], schema=_ENTRIES_SCHEMA)

    return rows.mapInArrow(run, _ENTRIES)


def fits(a_size: int, a_place: int, b_size: int, b_place: int, percent: int) -> bool:
    """Whether sets that first meet at these places of their order can be linked."""
    least = overlap(a_size, b_size, percent)
    return min(a_size, b_size) >= least and 1 + min(a_size - a_place, b_size - b_place) - 1 >= least


def _met(entries: DataFrame, percent: int) -> DataFrame:
    """What meets in a bucket or list: pairs to verify, members of long lists.

    Entries of long lists pass through, dealt out by set, so no task gets such a list. Of a bucket that
    goes on only its smallest set is held, of a list its members, which are LONG_LIST sets at most.
    """
    spark = entries.sparkSession
    spread_out = F.when(F.col("share") == LONG, F.pmod(F.xxhash64("key"), F.lit(1 << 20))).otherwise(0)
    dealt = entries.repartition(partitions(spark), F.col("token"), F.col("share"), spread_out).sortWithinPartitions("token", "share", "size", "key")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = np.zeros((5, 0), dtype=np.int64)
        ended = False
        source = iter(batches(it))
        while not ended:
            taken, n = [], 0
            for batch in source:
                taken.append(np.stack([c.to_numpy().astype(np.int64) for c in batch.columns]))
                n += batch.num_rows
                if n >= 100_000:
                    break
            else:
                ended = True
            x = np.concatenate([carry, *taken], axis=1)
            carry = x[:, :0]
            if not x.shape[1]:
                continue
            new = np.ones(x.shape[1], dtype=bool)
            new[1:] = (x[0, 1:] != x[0, :-1]) | (x[1, 1:] != x[1, :-1])
            # Copies of a class come from several tasks: keep one row of each.
            again = np.zeros(x.shape[1], dtype=bool)
            again[1:] = ~new[1:] & (x[3, 1:] == x[3, :-1])
            x, new = x[:, ~again], new[~again]
            if not ended:
                last = int(np.flatnonzero(new)[-1])
                if x[1, -1] == 0:
                    carry, x, new = x[:, last:], x[:, :last], new[:last]
                else:
                    carry = x[:, last : last + 1]
            group = np.cumsum(new)
            several = (np.bincount(group)[group] > 1) | (x[1] == LONG)
            x, group = x[:, several], group[several]
            if not x.shape[1]:
                continue
            edges = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]]).tolist()
            out: list[tuple] = []
            token, share, size, key, place = (c.tolist() for c in x)
            for p, q in zip(edges[:-1], edges[1:], strict=True):
                if share[p] > 0:
                    most = 100 * share[p] // percent + share[p]  # sizes of a linked pair sum to this at most
                    out += [(1, min(key[p], key[i]), 0, max(key[p], key[i]), 0, None, None) for i in range(p + 1, q) if size[p] + size[i] <= most]
                elif share[p] == 0 and q - p <= SHORT_LIST:
                    out += [(1, min(key[i], key[j]), 0, max(key[i], key[j]), 0, None, None) for i in range(p, q) for j in range(i + 1, q) if fits(size[i], place[i], size[j], place[j], percent)]
                else:
                    out += [(2, key[i], size[i], None, None, token[i], place[i]) for i in range(p, q)]
            if out:
                out = list(dict.fromkeys(out))
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out, strict=True), _FOUND_SCHEMA, strict=True)], schema=_FOUND_SCHEMA)

    return dealt.mapInArrow(run, _FOUND)


def _room(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Most that sets of these profiles can have in common: part by part the smaller count, without a bound where a part is cut at 255."""
    most = np.minimum(x, y).sum(axis=1, dtype=np.int64)
    most[((x == 255) | (y == 255)).any(axis=1)] = 1 << 40
    return most


def _members(lists: DataFrame, labels: DataFrame, classes: DataFrame) -> DataFrame:
    """Members of the long lists that hold several components, with the number of blocks and the smallest member ``m`` of their list."""
    known = lists.join(labels.withColumnRenamed("node", "a"), "a", "left").withColumn("component", F.coalesce("component", "a"))
    known = materialise(known.join(classes.select(F.col("key").alias("a"), "profile"), "a").select("token", "a_size", "a", "place", "component", "profile"), "members", few=True)
    rows = F.count(F.lit(1))
    blocks = F.ceil(rows / F.greatest(F.lit(LIST_BLOCK), F.least(F.lit(LARGEST_BLOCK), rows / 64))).cast("int").alias("blocks")
    lists = known.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"), blocks, F.min(F.struct("a_size", "a", "place", "component")).alias("m"))
    return materialise(known.join(lists.where("low < high").select("token", "blocks", "m"), "token").withColumn("own", F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int")), "split", few=True)


def _profiles(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, PARTS)


def _linkable(i: np.ndarray, j: np.ndarray, size: np.ndarray, place: np.ndarray, comp: np.ndarray, parts: np.ndarray, percent: int) -> np.ndarray:
    """Of index pairs, those of different components that sizes, places and profiles allow to be linked."""
    least = -(-percent * (size[i] + size[j]) // (100 + percent))
    ok = (comp[i] != comp[j]) & (np.minimum(size[i], size[j]) >= least) & (np.minimum(size[i] - place[i], size[j] - place[j]) >= least)
    ok[ok] = _room(parts[i[ok]], parts[j[ok]]) >= least[ok]
    return ok


def _once(found: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in np.unique(np.concatenate(found, axis=1), axis=1)], schema=_PAIR)


def _near(members: DataFrame, percent: int) -> DataFrame:
    """Some likely pairs of each block of a long list, a few for each member: its list's smallest member, and neighbours in three orders."""
    spark = members.sparkSession
    dealt = members.repartition(partitions(spark), "token", "own").sortWithinPartitions("token", "own", "a_size", "a")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        found, waiting = [], 0

        def close() -> None:
            nonlocal held, waiting
            (_, _, size, key, place, comp), parts = np.concatenate([h for h, _ in held], axis=1), np.concatenate([h for _, h in held])
            held = []
            every = np.arange(len(size))
            for order in (every, np.lexsort(parts.T[::-1]), np.lexsort(parts.T)):
                for step in (1, 2, 3):
                    i, j = order[:-step], order[step:]
                    ok = _linkable(i, j, size, place, comp, parts, percent)
                    found.append(np.stack([np.minimum(key[i[ok]], key[j[ok]]), np.maximum(key[i[ok]], key[j[ok]])]))
                    waiting += found[-1].shape[1]

        for batch in batches(it):
            x = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(6)])
            parts = _profiles(batch.column(6))
            cuts = np.flatnonzero((np.diff(x[:2]) != 0).any(axis=0)) + 1
            for k, (part, mine) in enumerate(zip(np.split(x, cuts, axis=1), np.split(parts, cuts), strict=True)):
                if held and (k or (held[-1][0][:2, -1] != part[:2, 0]).any()):
                    close()
                held.append((part, mine))
            if waiting > 1_000_000:
                yield _once(found)
                found, waiting = [], 0
        if held:
            close()
        if waiting:
            yield _once(found)

    near = dealt.select("token", "own", "a_size", "a", "place", "component", "profile").mapInArrow(run, "a long, b long")
    low, high = F.least(F.col("a_size"), F.col("m.a_size")), F.lit(percent) * (F.col("a_size") + F.col("m.a_size"))
    rest = F.least(F.col("a_size") - F.col("place"), F.col("m.a_size") - F.col("m.place"))
    first = members.where((F.col("component") != F.col("m.component")) & ((100 + percent) * low >= high) & ((100 + percent) * rest >= high))
    return near.union(first.select(F.least("a", "m.a").alias("a"), F.greatest("a", "m.a").alias("b"))).distinct()


def _across(members: DataFrame, percent: int) -> DataFrame:
    """All pairs of each long list that are of different components and can be linked, block by block."""
    spark = members.sparkSession
    own = F.col("own")
    meets = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least(k, own).alias("low"), F.greatest(k, own).alias("high"))))
    dealt = members.select("token", "a_size", "a", "place", "component", "profile", "own", meets.alias("at")).select("token", "at.low", "at.high", "own", "a_size", "a", "place", "component", "profile")
    dealt = dealt.repartition(partitions(spark), "token", "low", "high").sortWithinPartitions("token", "low", "high", "a_size", "a")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        found, waiting = [], 0

        def close() -> None:
            nonlocal held, waiting
            (token, low, top, block, size, key, place, comp), parts = np.concatenate([h for h, _ in held], axis=1), np.concatenate([h for _, h in held])
            held = []
            if (comp == comp[0]).all():
                return
            high = np.searchsorted(size, 100 * size // percent, side="right")
            for n in range(len(size) - 1):
                j = np.arange(n + 1, max(high[n], n + 1))
                j = j if low[0] == top[0] else j[block[j] != block[n]]
                i = np.full(len(j), n)
                ok = _linkable(i, j, size, place, comp, parts, percent)
                if ok.any():
                    found.append(np.stack([np.minimum(key[n], key[j[ok]]), np.maximum(key[n], key[j[ok]])]))
                    waiting += found[-1].shape[1]

        for batch in batches(it):
            x = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(8)])
            parts = _profiles(batch.column(8))
            cuts = np.flatnonzero((np.diff(x[:3]) != 0).any(axis=0)) + 1
            for k, (part, mine) in enumerate(zip(np.split(x, cuts, axis=1), np.split(parts, cuts), strict=True)):
                if held and (k or (held[-1][0][:3, -1] != part[:3, 0]).any()):
                    close()
                held.append((part, mine))
            if waiting > 1_000_000:
                yield _once(found)
                found, waiting = [], 0
        if held:
            close()
        if waiting:
            yield _once(found)

    return dealt.mapInArrow(run, "a long, b long").distinct()


def _plausible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose profiles leave room for a link: part by part an intersection is at most the smaller count."""
    side = lambda x: classes.select(F.col("key").alias(x), F.col("n_shingles").alias(f"{x}_size"), F.col("profile").alias(f"{x}_profile"))
    beside = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_size", "b_size", "a_profile", "b_profile")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            x, y = _profiles(batch.column(4)), _profiles(batch.column(5))
            total = (batch.column(2).to_numpy() + batch.column(3).to_numpy()).astype(np.int64)
            keep = pa.array((100 + percent) * _room(x, y) >= percent * total)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], schema=_PAIR)

    return beside.mapInArrow(run, "a long, b long")


def _whole(wanted: DataFrame, classes: DataFrame, rows: DataFrame, words: int, clashing: frozenset[int]) -> DataFrame:
    """``key, members`` of the wanted classes, made again from the text of one document of each."""
    ids = classes.join(wanted, "key").select(F.col("first_id").alias("doc_id"))
    packed = np.packbits(id_table(ids, "doc_id")).tobytes()
    schema = pa.schema([("key", pa.int64()), ("members", pa.binary())])

    def sets(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.unpackbits(np.frombuffer(packed, np.uint8)).view(bool)
        for _, texts in balanced((batch.filter(pa.array(marked[batch.column(2).to_numpy()])) for batch in batches(it)), BATCH_CHARS):
            part, size = [], 0
            for s in shingle_sets(texts, words):
                part.append((class_key(s, clashing), s.tobytes()))
                size += s.nbytes
                if size > ARROW_BYTES:
                    yield batch_of(schema, *zip(*part, strict=True))
                    part, size = [], 0
            if part:
                yield batch_of(schema, *zip(*part, strict=True))

    present = rows.withColumn("doc_id", F.coalesce("doc_id", F.lit(ABSENT))).withColumn("spot", id_place("doc_id"))
    return present.mapInArrow(sets, "key long, members binary").join(wanted, "key", "left_semi").dropDuplicates(["key"])


def _verified(pairs: DataFrame, classes: DataFrame, rows: DataFrame, words: int, percent: int, clashing: frozenset[int]) -> DataFrame:
    """The pairs whose whole sets pass.

    A set is sent once for some PARTNERS partners, which follow it one by one: no row holds two sets, a
    task holds two at a time, and a set with many partners is dealt out to many tasks.
    """
    pairs = materialise(_plausible(pairs, classes, percent), "plausible", few=True)
    whole = _whole(pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct(), classes, rows, words, clashing)
    degree = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).alias("parts"))
    pairs = pairs.join(degree, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"))
    partners = pairs.join(whole.withColumnRenamed("key", "b"), "b").select("a", "part", "b", "members")
    seeds = pairs.select("a", "part").distinct().join(whole.withColumnRenamed("key", "a"), "a").select("a", "part", F.lit(None).cast("long").alias("b"), "members")
    beside = seeds.union(partners).repartition(partitions(rows.sparkSession), "a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())

    def check(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = np.zeros(0, np.uint64)
        for batch in batches(it):
            kept = []
            for a, b, members in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
                if b is None:
                    mine = np.frombuffer(members.as_py(), np.uint64)
                    continue
                other = np.frombuffer(members.as_py(), np.uint64)
                at = np.minimum(np.searchsorted(mine, other), len(mine) - 1)
                same = int((mine[at] == other).sum())
                if 100 * same >= percent * (len(mine) + len(other) - same):
                    kept.append((a, b))
            if kept:
                yield batch_of(_PAIR, *zip(*kept, strict=True))

    return beside.mapInArrow(check, "a long, b long")


def near_duplicate_classes(docs: DataFrame, words: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` per input row: the size of its shingle set and the least id reachable by links.

    Two documents link when ``100 * intersection >= percent * union``. Null or wordless text has an
    empty set and is linked with nothing; fewer words than a shingle has are one shingle; equal sets
    are linked. Repeated rows are linked; a null id is never the least of others, and alone gives
    null; an empty table gives none; other columns are ignored.
    """
    return _classified(docs, words, percent, id_column, text_column)[0].select("doc_id", "n_shingles", "component_id")


def _classified(docs: DataFrame, words: int, percent: int, id_column: str = "doc_id", text_column: str = "text") -> tuple[DataFrame, frozenset[int]]:
    """The same with the ``key`` of the row's set and the ``component`` that the key is in (null without shingles), and the digests that are no keys."""
    ready(docs)
    rows = _texts(docs, id_column, text_column)
    dealt = spread(rows)
    measured = materialise(_measured(dealt, words), "measured")
    documents = measured.where("block IS NULL").select("doc_id", "n_shingles", "key", "second")
    classes, clashing = _classes(measured)
    if clashing:
        documents = documents.withColumn("key", F.when(F.col("key").isin(*clashing), F.col("second")).otherwise(F.col("key")))
    sizes = {r.n_shingles: r["count"] for r in classes.where(F.col("n_shingles") <= 2 * LARGEST_LIGHT).groupBy("n_shingles").count().collect()}
    light = boundary(sizes, percent)
    found = materialise(_met(_entries(dealt, words, percent, light, _frequent(measured), clashing), percent), "met", few=True)
    lists = found.where("kind = 2")
    check = lambda pairs: _verified(pairs, classes, rows, words, percent, clashing)
    tested = materialise(found.where("kind = 1").select("a", "b").distinct(), "pairs", few=True)
    labels = connected_components(materialise(check(tested), "links", few=True))
    if lists.limit(1).collect():
        # Likely pairs first: what they link needs no further look. Then all pairs of different components that are left.
        for pairs_of in (_near, _across):
            labels = materialise(labels, "labels", few=True)
            fresh = materialise(pairs_of(_members(lists, labels, classes), percent).join(tested, ["a", "b"], "left_anti"), "fresh", few=True)
            if not fresh.limit(1).collect():
                continue
            more = materialise(check(fresh), "links", few=True)
            tested = tested.union(fresh)
            labels = connected_components(more.union(labels.select(F.col("node").alias("a"), F.col("component").alias("b"))))
    member = classes.join(labels.withColumnRenamed("node", "key"), "key", "left").select("key", "first_id", F.coalesce("component", "key").alias("component"))
    least = member.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_key = materialise(member.join(least, "component").select("key", "component", "component_id"), "members", few=True)
    full = documents.join(by_key, "key", "left")
    out = full.select(
        "doc_id",
        F.col("n_shingles").cast("long").alias("n_shingles"),
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).when(F.col("component_id") == ABSENT, F.lit(None)).otherwise(F.col("component_id")).alias("component_id"),
        "key",
        "component",
    )
    return out, clashing


def _classes(measured: DataFrame) -> tuple[DataFrame, frozenset[int]]:
    """``key, n_shingles, profile, first_id`` of each distinct set, and the first digests that several sets have.

    There are about (sets)² / 2^65 of the latter: none up to some 10^9 sets, a few for 10^10.
    """
    rows = measured.where("n_shingles > 0").withColumn("first_id", F.coalesce("doc_id", F.lit(ABSENT)))

    def by(key: Column) -> DataFrame:
        return rows.withColumn("key", key).groupBy("key").agg(*(F.first(c).alias(c) for c in ("n_shingles", "profile")), F.min("first_id").alias("first_id"), (F.min("second") < F.max("second")).alias("several"))

    classes = materialise(by(F.col("key")), "classes", few=True)
    clashing = frozenset(r.key for r in classes.where("several").select("key").collect())
    if clashing:
        classes = materialise(by(F.when(F.col("key").isin(*clashing), F.col("second")).otherwise(F.col("key"))), "classes")
    return classes, clashing


def keep_first(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each class of near duplicates, that of the least id, all columns as they are.

    Texts under one id are judged apart, by their sets; of a class with several sets under its least
    id the set of the least key stays. Rows with a null id have no class to be the first of and stay,
    each by itself.
    """
    found, clashing = _classified(docs, words, percent)
    found = found.where("doc_id IS NOT NULL")
    counted = found.groupBy("doc_id").agg(F.min("component_id").alias("component_id"), F.count(F.lit(1)).alias("n"))
    doubtful = materialise(counted.where("doc_id <> component_id OR n > 1"), "doubtful", few=True)
    # Most rows are surely kept and stay where they are; the rest, and what hashes like it, is joined.
    table = id_table(doubtful, "doc_id")
    gone = doubtful.select(F.col("doc_id").alias("_gone"))
    rest = on_table(docs.where("doc_id IS NOT NULL"), "doc_id", table)
    once = rest.join(gone, rest["doc_id"] == gone["_gone"], "left_anti").select(docs.columns)
    kept = on_table(docs.where("doc_id IS NOT NULL"), "doc_id", table, hit=False).unionByName(once).unionByName(docs.where("doc_id IS NULL"))
    repeated = doubtful.where("n > 1").select("doc_id")
    if repeated.isEmpty():
        return kept
    firsts = found.join(repeated, "doc_id", "left_semi").where("doc_id = component_id").groupBy("doc_id", "component").agg(F.min("key").alias("key"))
    firsts = firsts.select(F.col("doc_id").alias("_first"), F.col("key").alias("_first_key"))
    keyed = _keyed(docs.join(repeated, "doc_id", "left_semi").select(docs.columns), words, clashing)
    same = keyed.join(firsts, (keyed["doc_id"] == firsts["_first"]) & (keyed["_key"] == firsts["_first_key"]), "left_semi")
    return kept.unionByName(same.dropDuplicates(["doc_id", "_key"]).select(docs.columns))


def _keyed(docs: DataFrame, words: int, clashing: frozenset[int]) -> DataFrame:
    """The rows with the key of their set as ``_key``."""
    last = len(docs.columns)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            keys = [class_key(s, clashing) for s in shingle_sets([t or "" for t in batch.column(last).to_pylist()], words)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:last], pa.array(keys, pa.int64())], names=[*batch.schema.names[:last], "_key"])

    return docs.select("*", F.col("text").cast("string").alias("_key")).mapInArrow(run, docs.withColumn("_key", F.lit(0).cast("long")).schema)
