"""Top-k search, packing, fingerprints and the Jaccard join against brute force."""

import hashlib
import random
import re
from collections import defaultdict
from zlib import crc32

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

from skeinworks.llm import fingerprints, jaccard_join, packing, topk_search  # noqa: E402
from skeinworks.llm.token_counts import ByteEncoder  # noqa: E402

BYTE = P.path("byte_bpe_50k.json")


def brute_top_k(rows, k):
    vectors = [(i, np.floor(256 * np.array(v, dtype=np.float64)).astype(np.int64)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, v in vectors:
        if q % 5 == 0:
            scored = sorted((-int((v * w).sum()), i) for i, w in vectors if i != q)
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("n", [1, 4, 300])
def test_top_k_equals_brute_force(spark, n, monkeypatch):
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", 16)
    rnd = random.Random(n)
    centres = [[rnd.gauss(0, 1) for _ in range(8)] for _ in range(5)]
    rows = [(i, [float(np.float32(c + rnd.gauss(0, 0.2))) for c in centres[min(i % 7, 4)]]) for i in range(n)]
    rows += [(1000 + i, rows[0][1]) for i in range(n // 10)]  # ties
    bad = [(2000, None), (2005, [1.0, None] + [0.0] * 6), (2010, [float("nan")] * 8), (None, rows[0][1]), (2015, [float("inf")] * 8)]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>")
    got = {tuple(r) for r in topk_search.top_k(table, topk_search.F.col("vec_id") % 5 == 0, k=3).collect()}
    assert got == brute_top_k(rows, 3)


def test_top_k_of_odd_vectors(spark):
    rows = [(5 * i % 35, [float(x) for x in range(i % 4)] + [0.5 * i], float(i), "q") for i in range(12)] + [(5, [1.0], 0.0, "again"), (40, [], 0.0, "empty")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cell double, score string").withColumn("v", topk_search.F.lit("x")).withColumn("distance", topk_search.F.lit(1))
    got = topk_search.top_k(table, topk_search.F.col("vec_id") % 5 == 0, k=3).collect()
    width = max(len(v) for _, v, _, _ in rows)
    vectors = [(i, [int(np.floor(256 * x)) for x in v] + [0] * (width - len(v))) for i, v, _, _ in rows]
    # A query id with several vectors is one query with all of them: its best scores are drawn from each.
    want = {}
    for i in {i for i, _ in vectors}:
        found = sorted({(-sum(a * b for a, b in zip(q, w, strict=True)), j, n) for k, q in vectors if k == i for n, (j, w) in enumerate(vectors) if j != i})
        want[i] = [(j, -s) for s, j, _ in found[:3]]
    single = [i for i in want if sum(k == i for k, _ in vectors) == 1]
    assert all([(r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank) if r.query_id == i] == want[i] for i in single)
    assert {r.query_id for r in got} == set(want)
    with pytest.raises(Exception, match="64 bits"):
        topk_search.top_k(spark.createDataFrame([(0, [1e300]), (1, [1.0])], "vec_id long, embedding array<double>"), topk_search.F.lit(True)).collect()
    with pytest.raises(Exception, match="64 bits"):
        topk_search.top_k(spark.createDataFrame([(0, [1e9]), (1, [1e8])], "vec_id long, embedding array<double>"), topk_search.F.lit(True)).collect()


def test_top_k_of_nothing(spark):
    assert topk_search.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), topk_search.F.lit(True)).count() == 0


def words(rnd, n, vocabulary=300):
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


def test_packing_places_every_id_once(spark):
    rnd = random.Random(4)
    rows = [(i, words(rnd, rnd.choice([1, 5, 40, 90, 400]))) for i in range(60)] + [(100, None), (101, ""), (None, words(rnd, 30)), (102, words(rnd, 9000))]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, length int")
    pieces = packing.pack(docs, BYTE, length=128).collect()
    enc = ByteEncoder(BYTE)
    ids = {i: np.array(enc.exact(t or "") + [0], "<u4") for i, t in rows}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == set(ids)
    for i, ps in by_doc.items():
        at = 0
        for p in sorted(ps, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids[i]) and p.ids_crc32 == crc32(ids[i][at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids[i])
    short = 0
    for ps in by_sequence.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= 128
        short += at < 128
    assert short <= 1
    assert packing.pack(docs.limit(0), BYTE).count() == 0


def test_neighbours_share_words():
    rnd = random.Random(1)
    rests = [packing.Rest(i, 20, 0, np.array([100 * (i % 4) + rnd.randrange(30) for _ in range(20)])) for i in range(40)]
    windows = list(packing.fill(rests, 100, 500))
    assert sum(n for w in windows for _, _, n in w) == 800
    alike = [len({i % 4 for i, _, _ in w}) for w in windows]
    assert sum(a <= 2 for a in alike) >= len(alike) - 2


def brute_fill(lists, length):
    """Windows by plain BM25: telling ids of the seed, unused neighbours in order of score, then those of the last one taken."""
    n, k1, b = len(lists), packing.K1, packing.B
    df, mean = defaultdict(int), sum(map(len, lists)) / len(lists)
    for ids in lists:
        for t in set(ids):
            df[t] += 1

    def weight(t, d):
        tf = lists[d].count(t)
        return 0.0 if not tf else np.log1p((n - df[t] + 0.5) / (df[t] + 0.5)) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(lists[d]) / mean))

    used, begun, out = [False] * n, [0] * n, []

    def near(seed):
        asked = sorted((t for t in set(lists[seed]) if df[t] > 1), key=lambda t: (-weight(t, seed), t))[: packing.QUERY_IDS]
        scores = {d: sum(weight(t, d) for t in asked) for d in range(n) if not used[d]}
        return sorted((d for d, x in scores.items() if x > 0), key=lambda d: (-scores[d], d))[: packing.NEIGHBOURS]

    pending = None
    while True:
        seed = pending if pending is not None else next((d for d in range(n) if not used[d]), None)
        if seed is None:
            return out
        window, room, pending = [], length, None

        def take(d):
            nonlocal room, pending
            size = min(room, len(lists[d]) - begun[d])
            window.append((d, begun[d], size))
            begun[d] += size
            room -= size
            used[d] = True
            if begun[d] < len(lists[d]):
                pending = d

        take(seed)
        asked = seed
        while room:
            found = near(asked)
            for fitting in (True, False):
                for d in found:
                    if room and not used[d] and (not fitting or len(lists[d]) <= room):
                        take(d)
            if not found:
                rest = next((d for d in range(n) if not used[d]), None)
                if rest is None:
                    break
                take(rest)
            asked = window[-1][0]
        out.append(window)


@pytest.mark.parametrize("seed", range(6))
def test_windows_are_filled_in_order_of_bm25(seed, monkeypatch):
    monkeypatch.setattr(packing, "NEIGHBOURS", 4)
    rnd = random.Random(seed)
    lists = [[rnd.randrange(40) + 40 * (i % 3) for _ in range(rnd.randint(1, 30))] for i in range(60)]
    got = list(packing.fill([packing.Rest(i, len(x), 0, np.array(x)) for i, x in enumerate(lists)], 64, 200))
    assert got == brute_fill(lists, 64)


def test_shards_weigh_by_the_whole_corpus(spark):
    rnd = random.Random(2)
    texts = [words(rnd, rnd.choice([3, 20, 150])) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    enc = ByteEncoder(BYTE)
    tails = [np.array(enc.exact(t) + [0])[len(enc.exact(t) + [0]) // 64 * 64 :] for t in texts]
    got = packing.measured(packing.tokenised(docs, BYTE, 64, 0), BYTE)
    want = packing.corpus_of(tails, packing.size_and_kind(BYTE)[0])
    assert got.n == want.n == sum(len(t) > 0 for t in tails) and got.mean == want.mean
    assert got.df.tolist() == want.df[: len(got.df)].tolist() and not want.df[len(got.df) :].any()
    rests = [packing.Rest(i, len(t), 0, t) for i, t in enumerate(tails) if len(t)]
    size = packing.size_and_kind(BYTE)[0]
    whole, shard = packing.Index(rests, size), packing.Index(rests[:10], size, got)
    known = {(t, d): w for t, d, w in zip(whole.term.tolist(), whole.doc.tolist(), whole.weight.tolist(), strict=True)}
    assert all(abs(known[t, d] - w) < 1e-9 for t, d, w in zip(shard.term.tolist(), shard.doc.tolist(), shard.weight.tolist(), strict=True))


def test_edited_fingerprints_equal_brute_force(spark):
    rnd = random.Random(8)
    rows = [(i * 3, words(rnd, rnd.randrange(0, 12))) for i in range(50)] + [(7, None), (8, "Same  Text"), (10, "same text"), (11, "x"), (13, "é" * 7), (None, "nul")]
    docs = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, place string")
    got = {r.doc_id: r for r in fingerprints.edited_fingerprints(docs).collect()}
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: -(r[0] if r[0] is not None else -(10**9)))
    assert len(got) == len(rows)
    for n, (i, text) in enumerate(ordered):
        after = ordered[(n + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == float(fingerprints.canonical(text) == fingerprints.canonical(edited))
        assert r.near_next == float(fingerprints.canonical(text) == fingerprints.canonical(after))
    assert got[8].fingerprint == got[10].fingerprint
    assert fingerprints.edited_fingerprints(docs.limit(0)).count() == 0
    one = fingerprints.edited_fingerprints(docs.where("doc_id = 11")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert fingerprints.groups(docs).where("copies > 1").collect()


def test_colliding_digests_are_told_apart(spark, monkeypatch):
    rows = spark.createDataFrame([("d", "x", "1"), ("d", "y", "2"), ("e", "z", "3")], "fingerprint string, text string, wide string")
    collided = spark.createDataFrame([("d",)], "fingerprint string")
    got = {r.text: r.fingerprint for r in fingerprints.resolved(rows, collided, ("fingerprint", "wide")).collect()}
    assert got == {"x": "d:1", "y": "d:2", "z": "e"}


def shingles(text, n):
    ws = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return frozenset() if not ws else frozenset([tuple(ws)]) if len(ws) < n else frozenset(tuple(ws[i : i + n]) for i in range(len(ws) - n + 1))


def brute_components(rows, n, percent):
    sets = [(i, shingles(t, n)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, (a, s) in enumerate(sets):
        for b, t in sets[:x]:
            both = len(s & t)
            if s and t and 100 * both >= percent * (len(s) + len(t) - both):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: (len(s), root(i)) for i, s in sets}


def edited(rnd, text, edits):
    ws = text.split()
    for _ in range(edits):
        k = rnd.randrange(len(ws))
        kind = rnd.randrange(3)
        if kind == 0:
            ws[k] = f"e{rnd.randrange(99)}"
        elif kind == 1 and len(ws) > 1:
            del ws[k]
        else:
            ws.insert(k, f"i{rnd.randrange(99)}")
    return " ".join(ws)


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80), (1, 70)])
def test_components_equal_brute_force(spark, n, percent):
    rnd = random.Random(percent)
    texts = []
    passage = words(rnd, 60, 5000)
    for size in (3, 9, 12, 18, 24, 30, 45, 90, 150):
        for _ in range(4):
            base = words(rnd, size, 4000)
            texts += [base, base.upper()] + [edited(rnd, base, rnd.randrange(1, 4)) for _ in range(6)]
        texts.append(words(rnd, size, 4000) + " " + passage)
    hot = words(rnd, 120, 4000)
    texts += [edited(rnd, hot, 1) for _ in range(40)]  # a long list of near copies
    texts += ["", " \t\n", "one", "one two", "ONE\x0btwo", None]
    rows = list(enumerate(texts))
    rnd.shuffle(rows)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, component_id string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicate_classes(docs, n, percent).collect()}
    assert got == brute_components(rows, n, percent)


def test_long_lists_meet_block_by_block(spark, monkeypatch):
    for name, value in (("SHORT_LIST", 2), ("LONG_LIST", 5), ("LIST_BLOCK", 6), ("PARTNERS", 3)):
        monkeypatch.setattr(jaccard_join, name, value)
    rnd = random.Random(6)
    texts = []
    for size, copies in ((140, 50), (100, 20), (70, 12)):
        base = words(rnd, size, 4000)
        texts += [edited(rnd, base, rnd.randrange(1, 7)) for _ in range(copies)]
    texts += [texts[0]] * 9 + [words(rnd, 50, 3000) for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicate_classes(docs, 3, 90).collect()}
    assert got == brute_components(list(enumerate(texts)), 3, 90)


def test_sets_of_equal_first_digests_are_told_apart(spark):
    rows = [(1, 5, 77, 1, b"p"), (2, 5, 77, 1, b"p"), (3, 6, 77, 2, b"q"), (4, 6, 78, 3, b"r")]
    classes, clashing = jaccard_join._classes(spark.createDataFrame(rows, "doc_id long, n_shingles int, key long, second long, profile binary"))
    assert clashing == {77} and {(r.key, r.first_id, r.n_shingles) for r in classes.collect()} == {(1, 1, 5), (2, 3, 6), (78, 4, 6)}
    s = np.arange(3, dtype=np.uint64)
    first, second = jaccard_join.class_keys(s)
    assert jaccard_join.class_key(s) == first != second == jaccard_join.class_key(s, frozenset([first]))


def test_join_of_odd_tables(spark):
    schema = "doc_id long, text string"
    assert jaccard_join.near_duplicate_classes(spark.createDataFrame([], schema)).count() == 0
    same = spark.createDataFrame([(5, "a b c d e f g"), (5, "a b c d e f g"), (None, "a b c d e f g"), (None, "q"), (7, None)], schema)
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in jaccard_join.near_duplicate_classes(same).collect())
    assert got == [(0, 1, 0), (0, 3, 5), (5, 3, 5), (5, 3, 5), (7, 0, 7)]
    kept = jaccard_join.keep_first(same.withColumn("lang", jaccard_join.F.lit("x")))
    assert kept.columns == ["doc_id", "text", "lang"] and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 5, 7]


def test_subsets_and_boundary():
    s = np.array([3, 5, 9, 11], dtype=np.uint64)
    got = list(jaccard_join.subsets(s, 2))
    assert len(got) == len(set(got)) == 1 + 4 + 6
    without = list(jaccard_join.subsets(np.array([3, 5], dtype=np.uint64), 0))
    assert without[0] in got
    assert jaccard_join.boundary({}, 90) == 1
    assert 10 <= jaccard_join.boundary({s: 100 for s in range(1, 60)}, 90) <= 20


def test_texts_under_one_id_are_judged_apart(spark):
    rnd = random.Random(6)
    near, other, third = words(rnd, 60, 9000), words(rnd, 60, 9000), words(rnd, 60, 9000)
    rows = [(1, near), (5, near + " more"), (5, other), (5, other), (7, other + " tail"), (8, third), (9, third), (9, near), (4, ""), (4, None)]
    kept = jaccard_join.keep_first(spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, lang string"))
    assert kept.columns == ["doc_id", "text", "lang"]
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == sorted([(1, near), (5, other), (8, third), (4, "")])
