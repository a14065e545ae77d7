"""Operators on small tables, against hand-made or brute-force results."""

import random
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skeinworks.operators import candidates, clusters, components, curation, evaluation, graph, grouping, lattice, reachability, retrieval, sequence


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_dense_position_and_islands(spark):
    df = spark.createDataFrame([(i, (i * 7) % 50) for i in range(50)], "id int, k int")
    got = {r.k: r.position for r in sequence.dense_position(df, ["k"]).collect()}
    assert got == {k: k for k in range(50)}
    assert sequence.dense_position(df.limit(0), ["k"]).count() == 0
    runs = sequence.islands(spark.createDataFrame([(1, 1, "a"), (1, 2, "a"), (1, 3, None), (1, 4, None), (1, 5, "a")], "g int, t int, v string"), ["g"], ["t"], "v")
    assert rows(runs.select("v", "first_at", "length")) == {("a", 1, 2), (None, 3, 2), ("a", 5, 1)}


def test_running_max_over_ranges(spark):
    rnd = random.Random(1)
    values = [(i, rnd.randrange(100)) for i in range(200)]
    got = {r.p: r.bound for r in sequence.running_max(spark.createDataFrame(values, "p int, v int"), "p", "v").collect()}
    assert got == {i: max(v for _, v in values[: i + 1]) for i, _ in values}


def test_quantile_level_ties(spark):
    df = spark.createDataFrame([("g", i, s) for i, s in enumerate([1, 1, 1, 2, 3])], "g string, id int, s int")
    assert [r.level for r in sequence.quantile_level(df, ["g"], "s").orderBy("id").collect()] == [1, 1, 1, 4, 5]


def random_dag(seed, n=25, p=0.15):
    rnd = random.Random(seed)
    return [(a, b) for a in range(n) for b in range(a + 1, n) if rnd.random() < p]


def closure_of(edges):
    out = set(edges)
    while True:
        more = {(a, d) for a, b in out for c, d in edges if b == c} - out
        if not more:
            return out
        out |= more


@pytest.mark.parametrize("seed", [1, 2])
def test_graph_against_brute_force(spark, seed):
    edges = random_dag(seed)
    e = spark.createDataFrame(edges, "src int, dst int")
    closed = closure_of(set(edges))
    assert rows(graph.closure(e)) == closed
    redundant = {(a, b) for a, b in edges if any(x == a and y != b and (y, b) in closed for x, y in edges)}
    assert rows(graph.transitive_reduction(e).where("NOT is_direct").select("src", "dst")) == redundant
    assert {(r.src, r.dst) for r in graph.witnesses(e).collect()} == redundant
    longest = {}
    for n in range(25):
        longest[n] = max((longest[a] + 1 for a, b in edges if b == n), default=0)
    touched = {x for ab in edges for x in ab}
    assert rows(graph.levels(e)) == {(n, longest[n]) for n in touched}
    assert graph.nodes_on_cycles(e).count() == 0 and rows(graph.nodes_on_cycles(e.union(spark.createDataFrame([(b, a) for a, b in edges[:1]], "src int, dst int")))) >= {(edges[0][0],)}
    rnd = random.Random(seed)
    place = {n: rnd.randrange(40) for n in touched}
    moved = graph.moved_to_fixpoint(e, spark.createDataFrame(list(place.items()), "node int, position int"))
    assert {(r.node, r.moved_to) for r in moved.collect()} == {(n, min([place[n], *(place[d] for s, d in closed if s == n)])) for n in touched}


@pytest.mark.parametrize(("seed", "n", "p", "small"), [(1, 12, 0.12, 0), (2, 24, 0.06, 1 << 20)])
def test_reachability_with_cycles(spark, seed, n, p, small):
    rnd = random.Random(seed)
    edges = [(a, b) for a in range(n) for b in range(n) if rnd.random() < p and (a != b or rnd.random() < 0.2)]
    # A long way round with one edge beside it, and a cycle that an edge avoids.
    edges += [(100, 101), (101, 102), (102, 103), (103, 104), (100, 104), (110, 111), (111, 112), (112, 111), (112, 113), (110, 113), (120, 120)]
    e = spark.createDataFrame([*edges, (None, 1), (5, None), edges[0]], "src int, dst int")
    closed = closure_of(set(edges))
    strong = {x: max(y for y in {b for a, b in closed if a == x} if (y, x) in closed) for x, y in closed if x == y}
    assert rows(reachability.strong_components(e, small)) == set(strong.items())
    assert rows(reachability.redundant_edges(e, small)) == {(a, b) for a, b in edges if any(x == a and (y, b) in closed for x, y in edges)}
    place = {x: rnd.randrange(40) for ab in edges for x in ab if rnd.random() < 0.8}
    moved = graph.moved_to_fixpoint(e, spark.createDataFrame(list(place.items()), "node int, position int"))
    assert rows(moved.select("node", "moved_to")) == {(x, min([place[x], *(place[d] for s, d in closed if s == x and d in place)])) for x in place}


@pytest.mark.parametrize("seed", range(20))
def test_walk_against_brute_force(seed):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(15), rnd.randrange(15)) for _ in range(rnd.randrange(1, 30))]
    closed = closure_of(set(edges))
    got = next(reachability._walked(iter([pd.DataFrame(edges, columns=["src", "dst"])])))
    want = {x: max(y for a, y in closed if a == x and (y, x) in closed) for x, y in closed if x == y}
    assert len(got) == len(want) and dict(zip(got["node"], got["component"], strict=True)) == want


def test_reachability_of_nothing(spark):
    e = spark.createDataFrame([(None, 1)], "src int, dst int")
    assert graph.levels(e).count() == graph.nodes_on_cycles(e).count() == reachability.redundant_edges(e).count() == graph.witnesses(e.where("src = 0")).count() == 0
    assert {r.is_direct for r in graph.transitive_reduction(e).collect()} == {True}


def test_shortcuts_at_a_hub(spark):
    """A hub with 300 edges in and out: each way through it is known from the ends, not from its pairs."""
    edges = [(i, 1000) for i in range(300)] + [(1000, 2000 + i) for i in range(300)] + [(i, 2000 + i) for i in range(0, 300, 3)]
    got = rows(reachability.shortcut_edges(spark.createDataFrame(edges, "src int, dst int")))
    assert got == {(i, 2000 + i) for i in range(0, 300, 3)}


def test_levels_refuse_cycles(spark):
    with pytest.raises(ValueError):
        graph.levels(spark.createDataFrame([(1, 2), (2, 1)], "src int, dst int"))


def test_chain_provenance(spark):
    e = spark.createDataFrame([(1, 2), (1, 3), (2, 4), (3, 4), (4, 1), (3, 5)], "src int, dst int")
    got = rows(graph.reach(e, spark.createDataFrame([(1,)], "start int")).select("node", "depth", "via"))
    assert got == {(2, 1, 1), (3, 1, 1), (4, 2, 2), (5, 2, 3)}
    assert rows(graph.reach(e, spark.createDataFrame([(5,)], "start int"), 1, backwards=True).select("node", "via")) == {(3, 5)}
    assert graph.reach(e, spark.createDataFrame([(9,)], "start int")).count() == 0


@pytest.mark.parametrize(("seed", "small"), [(0, 0), (1, 0), (2, 0), (3, 1 << 20), (4, 1 << 20)])
def test_components(spark, seed, small):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)]
    parent = {x: x for ab in edges for x in ab}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    got = rows(components.connected_components(spark.createDataFrame([*edges, (None, 3), (500, 500)], "a long, b long"), small=small))
    assert got == {(x, root(x)) for x in parent} | {(500, 500)}
    assert components.connected_components(spark.createDataFrame([], "a long, b long"), small=small).count() == 0


def cut_walk(links, apart):
    """Cuts the least link of a cluster that holds a forbidden pair, until none does."""
    nodes = {x for _, a, b in links for x in (a, b)}
    out, todo = {x: x for x in nodes}, [sorted(links)]
    while todo:
        group = todo.pop()
        near = {}
        for _, a, b in group:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
        left = set(near)
        while left:
            members, more = set(), [left.pop()]
            while more:
                x = more.pop()
                if x not in members:
                    members.add(x)
                    more += near[x]
            left -= members
            if any(a in members and b in members for a, b in apart):
                todo.append([e for e in group if e[1] in members][1:])
            else:
                out.update((x, min(members)) for x in members)
    return set(out.items())


def test_constrained_clusters(spark):
    links = spark.createDataFrame([(1, 2, 0.9), (2, 3, 0.4), (3, 4, 0.8), (7, 8, 0.1), (9, 9, 0.5), (None, 1, 0.5)], "a long, b long, confidence double")
    apart = spark.createDataFrame([(1, 4), (None, 2)], "a long, b long")
    assert rows(clusters.constrained_clusters(links, apart)) == {(1, 1), (2, 1), (3, 3), (4, 3), (7, 7), (8, 7), (9, 9)}
    assert rows(clusters.constrained_clusters(links.limit(0), apart)) == set()
    assert rows(clusters.constrained_clusters(links, apart.limit(0))) == {(1, 1), (2, 1), (3, 1), (4, 1), (7, 7), (8, 7), (9, 9)}


@pytest.mark.parametrize(("seed", "small"), [(1, 0), (2, 8), (3, 1 << 20), (4, 1 << 20), (5, 1 << 20)])
def test_constrained_clusters_against_cuts(spark, seed, small):
    rnd = random.Random(seed)
    pairs = sorted({tuple(sorted(rnd.sample(range(30), 2))) for _ in range(45)} | {(40 + i, 41 + i) for i in range(6)})
    links = [(rnd.randrange(10) / 10, a, b) for a, b in pairs]
    apart = {tuple(rnd.sample(range(30), 2)) for _ in range(4 + 2 * seed)} | {(40, 46), (44, 44)}
    got = clusters.constrained_clusters(spark.createDataFrame([(b, a, c) for c, a, b in links], "a long, b long, confidence double"), spark.createDataFrame(sorted(apart), "a long, b long"), small)
    assert rows(got) == cut_walk(links, apart)


def test_growing_of_a_large_component():
    """A million links in one component, of which a tenth of the nodes have a foe, in seconds."""
    n = 250_000
    rnd = np.random.default_rng(1)
    a, b = np.concatenate([np.arange(n - 1), rnd.integers(0, n, 3 * n)]), np.concatenate([np.arange(1, n), rnd.integers(0, n, 3 * n)])
    links = pd.DataFrame({"x": np.minimum(a, b), "y": np.maximum(a, b), "confidence": rnd.random(len(a)), "kind": 0})
    foes = pd.DataFrame({"x": rnd.integers(0, n, n // 10), "y": rnd.integers(0, n, n // 10), "confidence": 0.0, "kind": 1}).query("x != y")
    pdf = pd.concat([links.query("x != y"), foes])
    pdf["a"], pdf["b"] = pdf["x"], pdf["y"]
    began = time.time()
    final = clusters._grown(pdf).set_index("cluster")["final"]
    assert time.time() - began < 60
    assert len(final) == n and (final.loc[foes["x"]].to_numpy() != final.loc[foes["y"]].to_numpy()).all()


def test_mutual_and_inserted(spark):
    e = spark.createDataFrame([(1, 2), (2, 1), (3, 4), (4, 3), (5, 6)], "src int, dst int")
    stages = spark.createDataFrame([(1, 1), (2, 2), (3, 1), (4, 1), (5, 1), (6, 1)], "node int, stage int")
    assert rows(graph.without_mutual(e, stages)) == {(1, 2), (5, 6)}
    typed = e.withColumn("type", F.lit("p"))
    assert graph.inserted(typed, typed).count() == 5


FACTS = "dimension string, op string, token string, num long, position long"


def checked(spark, needs):
    facts = spark.createDataFrame(
        [("integer_domain", None, None, 20, 0), ("integer_domain", None, None, 100, 3), ("integer_domain", None, None, 50, 4), ("fraction_types", None, "真分数", None, 2), ("operation_forms", "乘法", "整数·乘数两位数", None, 1),
         ("operation_forms", "加法", "进位", None, 2), ("units_of_measure", None, "米", None, 1), ("concepts", None, "面积", None, 5)], FACTS)
    lessons = spark.createDataFrame([(f"l{i}", i, "u1" if i < 4 else "u2") for i in range(6)], "lesson_id string, position long, unit_id string")
    n = spark.createDataFrame([(item, lesson, d, op, t, need) for item, lesson, d, op, t, need in needs], "item_id string, lesson_id string, dimension string, op string, token string, need long")
    violations, reports = lattice.check_items(n, facts, lessons)
    return {(r.item_id, r.dimension, r.value, r.introduced) for r in violations.collect()}, {r.item_id: (r.verdict, r.n_unknown) for r in reports.collect()}


def test_boundary_check(spark):
    violations, verdicts = checked(
        spark,
        [("a", "l1", "integer_domain", None, None, 80), ("b", "l1", "integer_domain", None, None, 10), ("c", "l1", "fraction_types", None, "几分之一", None), ("d", "l2", "fraction_types", None, "几分之一", None), ("e", "l1", "operation_forms", "乘法", "整数·表内", None),
         ("f", "l1", "operation_forms", "加法", "整数", None), ("g", "l1", "concepts", None, "周长", None), ("h", "l1", "concepts", None, "面积", None), ("i", "l0", "fraction_types", None, "分数", None), ("j", "l1", "carry_or_borrow", None, None, None), ("k", "l5", "integer_domain", None, None, 500)],
    )
    assert violations == {("a", "integer_domain", "80", 3), ("c", "fraction_types", "几分之一", 2), ("f", "operation_forms", "整数", None), ("h", "concepts", "面积", 5), ("i", "fraction_types", "分数", 2), ("j", "carry_or_borrow", "进位/退位", 2), ("k", "integer_domain", "500", None)}
    assert verdicts == {"a": ("borderline", 0), "b": ("in", 0), "c": ("borderline", 0), "d": ("in", 0), "e": ("in", 0), "f": ("out", 0), "g": ("in", 1), "h": ("out", 0), "i": ("borderline", 0), "j": ("borderline", 0), "k": ("out", 0)}


def test_fold_is_order_independent(spark):
    rnd = random.Random(4)
    facts = [("d", "o", f"t{rnd.randrange(8)}", None, rnd.randrange(20)) for _ in range(60)]
    one = rows(lattice.introduced(spark.createDataFrame(facts, FACTS)))
    rnd.shuffle(facts)
    assert rows(lattice.introduced(spark.createDataFrame(facts, FACTS).repartition(3))) == one
    deltas = lattice.additions(spark.createDataFrame(facts, FACTS))
    rebuilt = lattice.rebuilt(deltas).orderBy("position").collect()
    assert all(set(a.allowed.split(",")) <= set(b.allowed.split(",")) for a, b in zip(rebuilt, rebuilt[1:], strict=False))


def test_coverage_with_repair(spark):
    items = spark.createDataFrame([("a", 1, "d", 5), ("b", 2, "d", 5), ("c", 2, "d", 4)], "item_id string, position long, dimension string, need long")
    grants = spark.createDataFrame([(0, "d", 3)], "position long, dimension string, num long")
    assert {r.item_id: r.ok for r in lattice.coverage_pass(items, grants).collect()} == {"a": False, "b": False, "c": False}
    assert {r.item_id: r.ok for r in lattice.coverage_pass(items, grants, repair=True).collect()} == {"a": False, "b": True, "c": True}


def test_tokens(spark):
    got = spark.range(1).select(retrieval.tokens(F.lit("分数乘 x1.5Ab 法")).alias("t"), retrieval.tokens(F.lit("分数乘"), True, True).alias("u"), retrieval.tokens(F.lit(None).cast("string")).alias("n")).first()
    assert got.t == ["分数", "数乘", "x", "1.5", "ab", "法"] and got.u == ["分数", "数乘", "分", "数", "乘", "分数乘"] and got.n == []


def test_diversified_equals_greedy(spark):
    rnd = random.Random(6)
    data = [(i, f"t{rnd.randrange(4)}", round(rnd.random(), 3)) for i in range(40)]
    used, pool, greedy = {}, list(data), []
    while pool and len(greedy) < 12:
        best = max(pool, key=lambda r: (round(r[2] * 0.8 ** used.get(r[1], 0), 9), -r[0]))
        pool.remove(best)
        used[best[1]] = used.get(best[1], 0) + 1
        greedy.append(best[0])
    df = spark.createDataFrame(data, "doc_id int, thread string, score double")
    assert [r.doc_id for r in retrieval.diversified(df, 12).orderBy("place").collect()] == greedy


def test_pooled_scores(spark):
    import math

    texts = {1: {"name": ["a", "bb"], "topic": ["a"]}, 2: {"name": ["c"], "topic": []}, 3: {"name": ["bb", "bb"], "other": ["a"]}}
    fields = spark.createDataFrame([(d, f, t) for d, x in texts.items() for f, t in x.items()], "doc_id int, field string, tokens array<string>")
    w = {"name": 2.0, "topic": 1.0}
    lengths = {d: sum(w.get(f, 0) * len(t) for f, t in x.items()) for d, x in texts.items()}
    mean = sum(lengths.values()) / 3
    want = {}
    for token, df in (("a", 1), ("bb", 2)):
        for d, x in texts.items():
            f = sum(w.get(name, 0) * t.count(token) for name, t in x.items())
            if f:
                part = math.log(1 + (3 - df + 0.5) / (df + 0.5)) * f * 2.4 / (f + 1.4 * (0.28 + 0.72 * lengths[d] / mean)) * (1.25 if len(token) == 2 else 1)
                want[d] = want.get(d, 0) + part
    queries = spark.createDataFrame([(7, ["a", "bb", "a"])], "query_id int, tokens array<string>")
    got = {r.doc_id: r.score for r in retrieval.pooled_scores(queries, fields, w).collect()}
    assert got == pytest.approx(want)
    assert retrieval.pooled_scores(queries, fields.limit(0), w).count() == 0
    row = spark.createDataFrame([("abc", "a b", 1, None, 2)], "name string, text string, g int, wanted int, other int")
    scope = retrieval.scope_factor((F.col("g"), F.col("wanted"), (1.9, 0.5)), (F.col("g"), F.col("other"), (1.4, 0.8)))
    assert tuple(row.select(scope, retrieval.named_factor(F.col("name"), F.col("text"))).first()) == (0.8, 1.5)


def test_parse_query():
    q = retrieval.parse_query("三年级下学期数与代数，想复习一下二年级学过的乘法", ("想",))
    assert (q.grades, q.semester, q.domains, q.scope) == ([3, 2], "b", ["na"], False)
    assert retrieval.parse_query("四年级这学期出一套综合卷").scope
    mix = retrieval.parse_query("小数除法，把之前学的乘法竖式也带进来")
    assert mix.weights == [1.0, 0.45]


def test_similar_pairs_keep_cosines(spark):
    docs = spark.createDataFrame([(1, ["a", "b"]), (2, ["a", "b"]), (3, ["a", "c"])], "doc_id int, tokens array<string>")
    w = retrieval.tfidf(docs)
    full = {(r.a, r.b): round(r.sim, 6) for r in retrieval.similar_pairs(w).collect()}
    capped = {(r.a, r.b): round(r.sim, 6) for r in retrieval.similar_pairs(w, most_docs=2).collect()}
    assert full[1, 2] == 1.0 and capped == {(1, 2): 1.0} and set(full) == {(1, 2), (1, 3), (2, 3)}


def test_agreement_and_clusters(spark):
    r = spark.createDataFrame([("x", "x"), ("x", "y"), ("y", "y"), ("y", "y")], "a string, b string")
    k = evaluation.cohen_kappa(r, "a", "b").first()
    assert (k.n, k.observed, k.expected, k.kappa) == (4, 0.75, 0.5, 0.5)
    assert evaluation.cohen_kappa(r.limit(0), "a", "b").first().kappa is None
    c = spark.createDataFrame([(1, "g1", "p1"), (2, "g1", "p1"), (3, "g2", "p1")], "i int, g string, p string")
    b = evaluation.bcubed(c, "i", "g", "p").first()
    assert (b.precision, b.recall) == (0.5556, 1.0)
    alpha = evaluation.krippendorff_alpha(spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (2, "b"), (3, "a")], "u int, l string"), "u", "l").first()
    assert alpha.alpha == 1.0


def test_wilson_and_bootstrap(spark):
    from skeinworks.functions.scalars import wilson

    w = spark.range(1).select(wilson(F.lit(24), F.lit(26)).alias("w"), wilson(F.lit(0), F.lit(0)).alias("z")).first()
    assert tuple(w.w) == (0.9231, 0.7586, 0.9786) and tuple(w.z) == (None, None, None)
    values = spark.createDataFrame([(i, float(i % 2)) for i in range(20)], "place int, v double")
    got = evaluation.bootstrap_interval(values, "v", 500).first()
    assert got.mean == 0.5 and 0.2 < got.lo < 0.5 < got.hi < 0.8


def test_backoff_and_attachment(spark):
    data = [(1, "k", "a", "x"), (2, "k", "a", "x"), (3, "k", "a", "y"), (4, "k", "b", "z")]
    got = {r.id: r.level for r in grouping.backoff_groups(spark.createDataFrame(data, "id int, base string, c string, d string"), ["base"], [["c", "d"], ["c"], []]).collect()}
    assert got == {1: 2, 2: 2, 3: 0, 4: 0}
    groups = spark.createDataFrame([(1, "k", "g1", "a"), (2, "k", "g1", "a"), (3, "k", "g2", "b"), (4, "k", "g2", "b"), (5, "k", "g3", "b")], "id int, base string, g string, d string")
    assert {r.id: r.g for r in grouping.attached_singletons(groups, ["base"], ["d"], "id", "g").collect()}[5] == "g2"


def test_canonical_merge_orders_aliases(spark):
    m = spark.createDataFrame([("c", 2, "k2", "B", ["x"], 2, False), ("c", 1, "k1", "A", ["B", "y"], 1, True)], "cluster string, position int, key string, name string, aliases array<string>, mastery_rank int, assessable boolean")
    r = grouping.canonical_merge(m).first()
    assert (r.name, r.aliases, r.mastery_rank, r.assessable, r.review_positions) == ("A", ["B", "y", "x"], 2, True, [2])


def test_routes_and_refs(spark):
    a = spark.createDataFrame([(1, 2, "r1"), (3, 3, "r1")], "a int, b int, route string")
    b = spark.createDataFrame([(1, 2, "r0"), (1, 2, "r1")], "a int, b int, route string")
    assert rows(candidates.united([a, b])) == {(1, 2, "r1,r0")}
    items = spark.createDataFrame([(1, "b", "p", ["q", "p", "q", "z"])], "i int, book string, main string, others array<string>")
    mapping = spark.createDataFrame([("b", "p", "P"), ("b", "q", "Q")], "book_id string, local_id string, canonical_id string")
    assert candidates.rewritten_refs(items, mapping, "i", "book", "main", "others").first().others == ["Q"]


def test_label_merging(spark):
    f = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a"), (4, "a"), (5, "a")], "item_id int, label string")
    s = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, "b")], "item_id int, label string")
    z = spark.createDataFrame([(2, "b", 0.9), (3, "c", 0.5)], "item_id int, label string, confidence double")
    assert rows(evaluation.merged_labels(f, s, z)) == {(1, "a", "consensus"), (2, "b", "arbitrated"), (3, "c", "queue"), (4, None, "failed"), (5, None, "failed")}
    late = z.union(spark.createDataFrame([(4, "c", None), (5, "b", 0.8)], z.schema))
    assert {(4, "c", "queue"), (5, "b", "arbitrated")} <= rows(evaluation.merged_labels(f, s, late))


def test_anchor_labels(spark):
    picks = spark.createDataFrame([(5, "x", 2, "extends"), (5, "y", 2, "same"), (5, "x", 9, "extends"), (5, "x", 5, "same"), (5, "y", None, "same"), (7, "y", 1, "extends")], "anchor int, annotator string, candidate int, relation string")
    screened = evaluation.screened_pairs(picks)
    got = {(r.anchor, r.candidate): (r.a, r.b, r.screened_by, r.relation) for r in screened.collect()}
    assert got == {(5, 2): (2, 5, ["x", "y"], "same"), (5, 9): (5, 9, ["x"], "extends"), (7, 1): (1, 7, ["y"], "extends")}
    assert tuple(evaluation.screening_overlap(screened).first()) == (3, 0.3333)
    assert tuple(evaluation.screening_overlap(screened.limit(0)).first()) == (0, None)
    labels = spark.createDataFrame([(2, 5, "same"), (5, 9, "same"), (1, 7, None)], "a int, b int, label string")
    anchors = spark.createDataFrame([(5,), (7,), (8,)], "anchor int")
    got = {r.anchor: (r.same, r.extends, r.n_decided) for r in evaluation.anchor_labels(anchors, screened, labels, ["same", "extends"]).collect()}
    assert got == {5: ([2, 9], [], 2), 7: ([], [], 0), 8: ([], [], 0)}


def test_gold_split(spark):
    one = lambda x: spark.createDataFrame([(x,)], "id string")
    part = lambda split: rows(evaluation.gold_split(one("d"), one("t"), one("h"), split))
    assert part("val") == {("d", False), ("t", True)} and part("test") == {("h", False)}
    assert part("all") == part("val") | part("test")
    with pytest.raises(ValueError):
        part("dev")


def test_standard_coverage(spark):
    judged = spark.createDataFrame([(1, "p", True, [3, 1]), (1, "q", None, [9]), (2, "p", True, None), (3, "p", False, [])], "item_id int, point string, covered boolean, nodes array<int>")
    points = spark.createDataFrame([(1, "textbook"), (3, "gap"), (4, None)], "node int, provenance string")
    got = {r.item_id: (r.verdict, r.nodes, r.missing) for r in curation.standard_coverage(judged, points, "pre").collect()}
    assert got == {1: ("partial", [1], "q"), 2: ("covered", [], ""), 3: ("not_covered", [], "p")}
    assert {r.item_id: r.nodes for r in curation.standard_coverage(judged, points, "post").collect()}[1] == [1, 3]
    assert curation.standard_coverage(judged.limit(0), points, "post").count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_longest_path(spark, seed):
    pairs = random_dag(seed)
    depth = {}
    for b in range(25):
        depth[b] = max((depth[x] + 1 for x, y in pairs if y == b), default=0)
    inner = {x for p in pairs for x in p}
    path = [min(n for n in inner if depth[n] == max(depth.values()))]
    while depth[path[-1]]:
        path.append(min(x for x, y in pairs if y == path[-1] and depth[x] + 1 == depth[y]))
    e = spark.createDataFrame(pairs, "src int, dst int")
    assert [r.node for r in graph.longest_path(e).orderBy("place").collect()] == path[::-1]
    assert graph.longest_path(e.limit(0)).count() == 0


def test_placement_and_coverage_rules(spark):
    lessons = spark.createDataFrame([(10, 1), (20, 2)], "lesson_id int, position int")
    schema = "node int, lesson_id int, origin string, moved boolean, note string"
    listed_schema = "lesson_id int, node int, part string"
    none = spark.createDataFrame([], "node int, lesson_id int")
    edges = spark.createDataFrame([(1, 2)], "src int, dst int")
    good = spark.createDataFrame([(1, 20, "reconciled", True, "why"), (2, 20, "textbook", False, None)], schema)
    listed = spark.createDataFrame([(20, 1, "intro"), (20, 2, "intro")], listed_schema)
    assert graph.placement_violations(good, lessons, listed, none, edges).count() == 0
    bad = spark.createDataFrame([(1, 10, "reconciled", True, None), (2, 20, "textbook", False, None), (3, 99, "textbook", False, None)], schema)
    wrong = spark.createDataFrame([(20, 1, "intro"), (20, 2, "intro"), (20, 2, "practice"), (10, 8, "practice")], listed_schema)
    reviews = spark.createDataFrame([(2, 10)], "node int, lesson_id int")
    got = rows(graph.placement_violations(bad, lessons, wrong, reviews, edges))
    assert got == {
        ("unknown point", 8, 10), ("no position", 3, 99), ("introduced elsewhere", 1, 20), ("introduced and practised", 2, 20),
        ("not listed", 1, 10), ("review too early", 2, 10), ("move not minimal", 1, 10), ("no note", 1, 10),
    }
    items = spark.createDataFrame([(1, "covered", [2], None), (2, "covered", [2, 9], None), (3, "covered", None, None), (4, "uncovered", [], None), (5, "not_applicable", [], ""), (6, "not_applicable", [], "no")], "item_id int, status string, nodes array<int>, reason string")
    assert rows(graph.coverage_violations(items, good)) == {("bad reference", 2), ("bad reference", 3), ("uncovered", 4), ("no reason", 5)}


def test_curation(spark):
    d = spark.createDataFrame([(1, "keep", None), (2, "merge", 1), (3, "merge", 2)], "source_id int, action string, target int")
    assert rows(curation.resolved_curation(d)) == {(1, "keep", "2"), (2, "merge", ""), (3, "keep", "")}
    log = spark.createDataFrame([(1, "ok", "old"), (2, "failed", "old")], "id int, status string, o string")
    new = spark.createDataFrame([(1, "ok", "new"), (2, "ok", "new"), (3, "ok", "new")], "id int, status string, o string")
    assert rows(curation.appended(log, new)) == {(1, "ok", "old"), (2, "ok", "new"), (3, "ok", "new")}


def test_graph_violations(spark):
    points = spark.createDataFrame([(i, i) for i in range(1, 6)], "node int, position int")
    good = spark.createDataFrame([(1, 2, True), (2, 3, True), (1, 3, False)], "src int, dst int, is_direct boolean")
    assert graph.violations(good, points).count() == 0
    bad = good.union(spark.createDataFrame([(4, 4, True), (5, 9, True), (3, 2, True), (2, 3, True)], "src int, dst int, is_direct boolean"))
    found = {r.rule for r in graph.violations(bad, points).collect()}
    assert {"missing end", "self loop", "repeated", "mutual", "against order", "cycle"} <= found


def test_pair_and_closure_scores(spark):
    gold = spark.createDataFrame([(1, 2), (2, 3)], "src int, dst int")
    pred = spark.createDataFrame([(1, 2), (1, 3), (4, 5)], "src int, dst int")
    r = evaluation.closure_scores(gold, pred).first()
    assert (r.tp, r.fp, r.fn, r.f1) == (2, 1, 1, 0.6667)
    named = lambda df: df.select(F.col("src").alias("a"), F.col("dst").alias("b"))
    c = evaluation.candidate_recall(named(gold), named(pred)).first()
    assert (c.k, c.n, c.p) == (1, 2, 0.5)


def test_local_points(spark):
    one = spark.createDataFrame([("p1", "l2"), ("p2", None)], "id string, introduced_in string")
    two = spark.createDataFrame([("p1", "l1")], "id string, introduced_in string")
    places = spark.createDataFrame([("l1", 0), ("l2", 1)], "lesson_id string, position int")
    assert {(r.key, r.seq) for r in candidates.local_points([("b", one), ("c", two)], places).collect()} == {("c::p1", 0), ("b::p1", 1), ("b::p2", 2)}


def test_bootstrap_draws_from_every_row(spark):
    rows = spark.range(150_000).select(F.col("id").alias("place"), (F.col("id") >= 100_000).cast("int").alias("v"))
    got = evaluation.bootstrap_interval(rows, "v", 2000).first()
    assert got.mean == 0.3333
    half = 1.96 * (2 / 9 / 150_000) ** 0.5
    assert abs(got.lo - (1 / 3 - half)) < 3e-4 and abs(got.hi - (1 / 3 + half)) < 3e-4
    thirds = spark.createDataFrame([(i, float(i % 3)) if i < 30 else (i, None) for i in range(40)], "place int, v double")
    got = evaluation.bootstrap_interval(thirds, "v").first()
    rng = random.Random(1)
    means = sorted(sum(rng.choices([0, 1, 2], k=30)) / 30 for _ in range(10_000))
    assert got.mean == 1.0 and abs(got.lo - means[250]) < 0.04 and abs(got.hi - means[9750]) < 0.04


def test_places_and_ranks_in_large_groups(spark):
    """One group holds most rows and one score a third of them; both reach over several ranges."""
    rnd = random.Random(3)
    data = [(i, rnd.choice(["big", "big", "big", "small", None]), rnd.choice([5.0, 5.0, None, *map(float, range(9))])) for i in range(400)] + [(1000, "one", 1.0)]
    df = spark.createDataFrame(data, "id int, g string, s double")
    by: dict = {}
    for i, g, s in data:
        by.setdefault(g, []).append((s is not None, s or 0.0, i))
    places = {(g, i): n for g, members in by.items() for n, (_, _, i) in enumerate(sorted(members))}
    got = sequence.place_in_group(df, ["g"], ["s", "id"]).collect()
    assert {(r.g, r.id): r.place for r in got} == places
    ranks = {(g, i): sum(m[:2] < (k, s) for m in members) for g, members in by.items() for k, s, i in members}
    got = sequence.first_rank(df, ["g"], "s").collect()
    assert {(r.g, r.id): r.rank for r in got} == ranks and all(r.rank_of == len(by[r.g]) for r in got) and len(got) == len(data)
    split = sequence.alternate_split(df, ["g"], ["id"]).collect()
    order = {(g, i): n for g, members in by.items() for n, i in enumerate(sorted(m[2] for m in members))}
    assert all(r.split == ("val" if order[r.g, r.id] % 2 == 0 else "test") for r in split)
    assert sequence.place_in_group(df.limit(0), ["g"], ["id"]).count() == 0 and sequence.first_rank(df.limit(0), ["g"], "s").count() == 0


def test_attachment_equals_the_walk_over_members(spark):
    rnd = random.Random(4)
    data = [(i, rnd.choice(["hot", "hot", "hot", "cold", None]), f"g{rnd.choice([1, 2, 3, *range(10, 200)])}", rnd.choice(["a", "b", None]), rnd.choice([1, 2, None])) for i in range(300)]
    want = {}
    for base in {r[1] for r in data}:
        rows_ = sorted(r for r in data if r[1] == base) if base else sorted((r for r in data if r[1] is None), key=lambda r: r[0])
        members: dict = {}
        for i, _, g, *mine in rows_:
            members.setdefault(g, []).append(mine)
        for i, _, g, *mine in rows_:
            want[i] = g
            others = [(sum(x == y for m in ms for x, y in zip(mine, m, strict=True)) / len(ms), len(ms), name) for name, ms in members.items() if name != g and len(ms) > 1]
            if len(members.get(g, ())) == 1 and others:
                want[i] = min(others, key=lambda o: (-o[0], -o[1], o[2]))[2]
                members[want[i]].append(mine)
                del members[g]
    table = spark.createDataFrame(data, "id int, base string, g string, d string, e int")
    assert {r.id: r.g for r in grouping.attached_singletons(table, ["base"], ["d", "e"], "id", "g").collect()} == want


def test_bootstrap_of_values_that_all_differ(spark):
    rows = spark.range(3000).select((F.col("id") * F.lit(0.37) % 11).alias("v"))
    xs = [r.v for r in rows.collect()]
    mean = sum(xs) / len(xs)
    half = 1.96 * (sum((x - mean) ** 2 for x in xs) / len(xs) / len(xs)) ** 0.5
    got = evaluation.bootstrap_interval(rows, "v", 2000).first()
    assert abs(got.mean - mean) < 1e-4 and abs(got.lo - (mean - half)) < 0.1 * half and abs(got.hi - (mean + half)) < 0.1 * half
    assert tuple(got) == tuple(evaluation.bootstrap_interval(rows, "v", 2000).first())
    assert evaluation.bootstrap_interval(rows.where("v IS NULL"), "v").count() == 0


def test_nodes_apart_are_paired_inside_components_only(spark, monkeypatch):
    """F8: all pairs of a group were made and shuffled, though only those of one component count."""
    rnd = random.Random(8)
    links = [(round(rnd.random(), 3), 10 * c + i, 10 * c + i + 1) for c in range(60) for i in range(7)]
    group = {10 * c + i: rnd.choice((None, 0, 1, 2, 3)) for c in range(60) for i in range(9)}
    apart = {(a, b) for a in group for b in group if a < b and group[a] is not None and group[a] == group[b]}
    sizes, real = {}, clusters.materialise
    monkeypatch.setattr(clusters, "materialise", lambda df, name, **more: (out := real(df, name, **more), sizes.update({name: out.count()}))[0])
    nodes = spark.createDataFrame([(n, g, "x") for n, g in group.items()], "node long, g int, kind string")
    got = clusters.constrained_clusters(spark.createDataFrame([(b, a, c) for c, a, b in links], "a long, b long, confidence double"), nodes)
    assert rows(got) == cut_walk(links, apart)
    assert max(sizes.values()) <= len(group) < len(apart)
