"""Ranked search, vector codes and near duplicates of embeddings against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from skeinworks.llm import embedding_dedup, ranked_search, vector_codes

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def said(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_search(docs, items, k):
    known = [(i, Counter(said(t))) for i, t in docs if said(t)]
    n, total = len(known), sum(sum(c.values()) for _, c in known)
    df = Counter(t for _, c in known for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c in known:
            m = 50 + 50 * sum(c.values()) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in set(said(text)) if t in c)
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -score) for rank, (score, _, _, doc) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def text_of(rnd, n):
    return " ".join(rnd.choice(["The", "the", "über", "x9", "日本", "a b", "c\x85d"] + [f"w{int(rnd.expovariate(0.05))}" for _ in range(8)]) + rnd.choice(["", ",", "\n", "\x00"]) for _ in range(n))


@pytest.mark.parametrize("size", [1 << 22, 40])
def test_search_equals_brute_force(spark, size, monkeypatch):
    monkeypatch.setattr(ranked_search, "SHARD_TERMS", size)
    monkeypatch.setattr(ranked_search, "BLOCK_TERMS", 30)
    rnd = random.Random(size)
    docs = [(rnd.choice([i, -i, i << 40]), text_of(rnd, rnd.choice([1, 5, 30, 200]))) for i in range(120)]
    docs += [docs[3], docs[3], (None, docs[3][1]), (None, None), (7001, ""), (7002, " ,;"), (2**63 - 1, docs[4][1]), (-(2**63), docs[4][1]), (7003, text_of(rnd, 30_000))]
    items = [(i, text_of(rnd, rnd.choice([1, 4, 20]))) for i in range(25)] + [(3, docs[3][1]), (None, "the"), (40, None), (41, ""), (42, "nowhere"), (43, docs[4][1])]
    table = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, score int, term string").repartition(3)
    asked = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, rank int")
    got = ranked_search.search(ranked_search.build(table), asked, k=7)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_search(docs, items, 7)


def test_search_of_nothing(spark):
    none, some = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    item = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked_search.search(ranked_search.build(none), item).count() == 0
    assert ranked_search.search(ranked_search.build(some), item.limit(0)).count() == 0
    assert ranked_search.search(ranked_search.build(some.withColumn("text", F.lit(None).cast("string"))), item).count() == 0


def test_numbers_round_trip():
    rnd = random.Random(2)
    x = np.array([0, 1, 127, 128, 2**63 - 1] + [rnd.randrange(1 << rnd.randrange(1, 63)) for _ in range(500)], np.int64)
    assert (ranked_search.numbers(ranked_search.varints(x)[0].tobytes()) == x).all()
    signed = np.array([0, -1, 1, -(2**63), 2**63 - 1, -5], np.int64)
    assert (ranked_search.unfolded(ranked_search.numbers(ranked_search.varints(ranked_search.folded(signed))[0].tobytes())) == signed).all()


def test_merge_skips_only_what_cannot_count():
    """Terms without a cursor change no result: every k against a full sum."""
    rnd = random.Random(5)
    lists = []
    for n, top in ((400, 3), (300, 10), (40, 200), (5, 900)):
        docs = sorted(rnd.sample(range(500), n))
        shares = [rnd.randint(0, top) for _ in docs]
        lists.append((docs, shares))
    sums = Counter()
    for docs, shares in lists:
        sums.update(dict(zip(docs, shares, strict=True)))
    for k in (1, 5, 50, 600):
        heap = []
        made = [ranked_search.Postings(d, s, max(s), sorted(s)[-k] if len(s) >= k else 0) for d, s in lists]
        ranked_search.merge(made, [-d for d in range(500)], heap, k)
        assert sorted(heap, reverse=True) == sorted(((s, -d) for d, s in sums.items() if s > 0), reverse=True)[:k]


# ---- codes


def brute_codes(rows, parts, entries, rounds):
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(1, -(-max(len(v) for _, v, _ in kept) // parts))
    kept = [(i, v + [0] * (parts * width - len(v)), label) for i, v, label in kept]
    begin = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, np.array(r[1], "<i8").tobytes()))[:entries]
    books = [[v[p * width : (p + 1) * width] for _, v, _ in begin] for p in range(parts)]

    def near(p, v):
        x = v[p * width : (p + 1) * width]
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        found = [[near(p, v)[1] for _, v, _ in kept] for p in range(parts)]
        for p in range(parts):
            for e in range(len(books[p])):
                own = [v[p * width : (p + 1) * width] for (_, v, _), at in zip(kept, found[p], strict=True) if at == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    out, sums = [], Counter()
    for i, v, label in kept:
        found = [near(p, v) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), label))
        sums[label] += out[-1][2]
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return sorted(((i, code, error, sums[label], digest) for i, code, error, label in out), key=str)


@pytest.mark.parametrize("n, width", [(3, 6), (90, 12), (200, 32)])
def test_codes_equal_brute_force(spark, n, width):
    rnd = random.Random(n)
    rows = [(rnd.choice([i, -i]), [rnd.gauss(0, 1) if rnd.random() < 0.9 else 0.0 for _ in range(width)], rnd.choice([None, "a", "b"])) for i in range(n)]
    rows += [rows[0], (None, rows[1][1], "a"), (5000, [], "c"), (5001, [1.0], None), (5002, [3e6] * width, "big")]
    bad = [(6000, None, "a"), (6001, [1.0, None], "a"), (6002, [float("nan")] * width, "a"), (6003, [float("-inf")] * width, None)]
    table = spark.createDataFrame([(*r, "z", 1) for r in rows + bad], "vec_id long, embedding array<double>, label string, code string, error int").repartition(3)
    got = vector_codes.compress(table, parts=4, entries=8, rounds=2)
    assert sorted(map(tuple, got.collect()), key=str) == brute_codes(rows, 4, 8, 2)


def test_codes_of_nothing_and_of_wide_numbers(spark):
    table = spark.createDataFrame([(1, None, 1)], "vec_id long, embedding array<float>, label int")
    assert vector_codes.compress(table).count() == 0
    assert vector_codes.compress(table.limit(0)).count() == 0
    with pytest.raises(Exception, match="64 bits"):
        vector_codes.compress(spark.createDataFrame([(1, [1e300], 1)], "vec_id long, embedding array<double>, label int")).collect()


def test_bounds_never_exceed_the_distance():
    rng = np.random.default_rng(3)
    for width in (1, 3, 4, 7, 16):
        x, book = rng.integers(-300, 300, (200, width)), rng.integers(-300, 300, (30, width))
        book[5] = book[20]  # a tie goes to the lower index
        index, least = vector_codes.nearest(x, book)
        every = ((x[:, None] - book[None]) ** 2).sum(axis=2)
        assert (index == every.argmin(axis=1)).all() and (least == every.min(axis=1)).all()
        for blocks in (1, 2, 4):
            if blocks <= width:
                (m, r), (cm, cr) = vector_codes.segments(x.astype(float), blocks), vector_codes.segments(book.astype(float), blocks)
                assert (((m[:, None] - cm[None]) ** 2).sum(axis=2) + (r[:, None] - cr[None]) ** 2 <= every + 1e-6).all()


# ---- near duplicates


def brute_links(rows, least):
    """By row: the links and the least id reachable."""
    good = [i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v) for i, v, label in rows]
    dim = max(len(v or []) for _, v, _ in rows)
    x = np.array([[*v, *[0.0] * (dim - len(v))] if ok else [1.0] * dim for (_, v, _), ok in zip(rows, good, strict=True)])
    x /= np.abs(x).max(axis=1, keepdims=True)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    same = np.array([[a[2] == b[2] for b in rows] for a in rows]) & np.outer(good, good) & ((x @ x.T) >= least)
    np.fill_diagonal(same, False)
    out = []
    for start, (i, _, _) in enumerate(rows):
        seen, todo = {start}, [start]
        while todo:
            for n in np.flatnonzero(same[todo.pop()]).tolist():
                if n not in seen:
                    seen.add(n)
                    todo.append(n)
        lowest = min(rows[n][0] for n in seen) if i is not None else None
        out.append((i, int(same[start].sum()), lowest, i == lowest))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [4096, 25])
def test_near_duplicates_equal_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    monkeypatch.setattr(embedding_dedup, "LISTED", 0 if block == 25 else 100_000)
    rng = np.random.default_rng(block)
    centre = rng.normal(size=(12, 24))
    rows = [(int(i), (centre[i % 12 if i > 90 else 0] + rng.normal(size=24) * rng.choice([0, 0.02, 0.09])).astype(np.float32).tolist(), int(rng.integers(2))) for i in rng.permutation(260)]
    rows += [(500, rows[0][1], rows[0][2]), (501, [2 * x for x in rows[0][1]], rows[0][2]), (501, rows[0][1], rows[0][2]), (502, rows[0][1], None), (503, [-0.0, 1.0], 0), (504, [0.0, 2.0], 0)]
    rows += [(600, None, 1), (601, [], 1), (602, [0.0] * 24, 1), (603, [0.0] * 24, 1), (604, [float("nan")] * 24, 1), (605, [1.0, None], 1), (None, rows[0][1], 0)]
    table = spark.createDataFrame([(*r, 3, "k") for r in rows], "vec_id long, embedding array<float>, label int, uid int, kept string")
    got = embedding_dedup.near_duplicates(table)
    want = [(i, n, c, True if i is None else k) for i, n, c, k in brute_links(rows, 0.98)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_near_duplicates_of_nothing_and_of_extremes(spark):
    ddl = "vec_id long, embedding array<double>, label string"
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], ddl)).count() == 0
    assert [tuple(r) for r in embedding_dedup.near_duplicates(spark.createDataFrame([(1, None, "a")], ddl)).collect()] == [(1, 0, 1, True)]
    rows = [(1, [1e300, 1e300], "a"), (2, [1e-300, 1e-300], "a"), (3, [1e300, -1e300], "a")]
    assert sorted(map(tuple, embedding_dedup.near_duplicates(spark.createDataFrame(rows, ddl)).collect())) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


@pytest.mark.parametrize("dim", [32, 64, 300])
def test_pairs_at_the_limit_meet(dim):
    """Recall where it is lowest: pairs whose cosine is 0.98 exactly."""
    rng = np.random.default_rng(dim)
    x, y = rng.normal(size=(2, 4000, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    u, v = embedding_dedup.bucket_codes(x), embedding_dedup.bucket_codes(0.98 * x + math.sqrt(1 - 0.98**2) * y)
    met = ((u == v[:, :, :1]) | (v == u[:, :, :1])).any(axis=(1, 2))
    assert met.mean() >= 0.99


def test_counts_of_links_are_of_distinct_pairs():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1, 16)) + 0.05 * rng.normal(size=(60, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    codes = embedding_dedup.bucket_codes(x, 3, 2)
    found = defaultdict(int)
    for t in range(3):
        for code in np.unique(codes[:, t]).tolist():
            rows = np.flatnonzero((codes[:, t] == code).any(axis=1))
            here = np.arange(len(rows))
            for a, b in embedding_dedup.linked(x[rows], here, here, codes[rows, t, 0] == code, codes[rows], t, code, 0.98):
                for pair in zip(rows[a].tolist(), rows[b].tolist(), strict=True):
                    found[tuple(sorted(pair))] += 1
    assert set(found.values()) == {1}
    assert len(found) <= int(np.triu(x @ x.T >= 0.98, 1).sum())
