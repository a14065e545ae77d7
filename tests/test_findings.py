"""Cases of the findings of round 3, each of which failed before its repair."""

import json
import random
from collections import Counter

from pyspark.sql import functions as F

from skeinworks import session
from skeinworks.functions import generate, mining
from skeinworks.operators import candidates, curation, graph, grouping
from skeinworks.plans.catalogue import QUERIES


def test_differing_lines_keep_their_places_in_the_example_pool(spark, tmp_path):
    lines = [(1, 10, 1, "A"), (1, 10, 1, "R"), (1, 11, 1, "N"), (1, 12, 1, None), (1, 12, 2, "A"), (2, 12, 1, "A"), (2, 12, 1, "A")]
    spark.createDataFrame(lines, "l_partkey long, l_orderkey long, l_linenumber int, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {tuple(r) for r in QUERIES["example_pool"](spark, str(tmp_path)).collect()}
    assert got == {(1, "N-11", 3), (1, "-12", 4), (2, "A-12", 1)}


CARD = {"template": "{a}+{b}=", "slots": {"a": {"type": "int", "min": 1, "max": 60}, "b": {"type": "fraction", "max_denominator": 7}}, "constraints": ["a % 3 == 0"], "answer": "a+b"}


def test_draws_are_made_as_they_are_asked_for(monkeypatch):
    asked = []
    ask = generate.Child.ask
    monkeypatch.setattr(generate.Child, "ask", lambda self, job, seconds=10.0, **given: asked.append(given.get("n")) or ask(self, job, seconds, **given))
    with generate.Child() as child:
        whole = child.ask("candidates", 20.0, slots=CARD["slots"], constraints=CARD["constraints"], seed=5, n=50)["out"]
        asked.clear()
        assert generate.instantiate(CARD, 5, 50, at=child)["params"] == whole[0]["params"] and asked == [1]
        asked.clear()
        most = min(c["params"]["a"] for c in whole)
        bound = {f"{d}_{w}": v for w in ("now", "unit") for d, v in (("integer", most), ("decimal", 9), ("fractions", 31))}
        fit = [c["params"] for c in whole if generate.verdict(generate.params_features(c["params"], CARD["slots"]), bound) == "in"]
        assert generate.instantiate(CARD, 5, 50, bound, ("in",), child)["params"] == fit[0] and sum(asked) <= 50
        several = [child.ask("candidates", 20.0, slots=CARD["slots"], constraints=CARD["constraints"], seed=5, n=n, start=start)["out"] for start, n in ((0, 1), (1, 2), (3, 4), (20, 5))]
        assert several == [whole[:1], whole[1:3], whole[3:7], whole[20:25]]


def test_exercises_of_a_small_file_are_made_by_many_tasks(spark):
    endless = {"template": "{a}", "slots": {"a": {"type": "int", "min": 1, "max": 9}}, "constraints": ["a > 9"], "answer": "a"}
    rows = [("c", json.dumps(CARD), n) for n in range(300)] + [("none", json.dumps(endless), 1), ("bad", "[", 1), ("kind", json.dumps(CARD | {"slots": {"a": {"type": "x"}}}), 1), ("seed", json.dumps(CARD), None)]
    cards = spark.createDataFrame(rows, "card_id string, card string, seed long").coalesce(1)
    made = generate.instantiate_many(cards)
    assert made.rdd.getNumPartitions() > 8
    got = {(r.card_id, r.seed): r for r in made.collect()}
    assert {k: got[k, 1].error for k in ("none", "bad", "kind")} == {"none": "Unsatisfiable", "bad": "JSONDecodeError", "kind": "ValueError"} and got["seed", None].error == "ValueError"
    with generate.Child() as child:
        for n in range(0, 300, 37):
            one = generate.instantiate(CARD, n, at=child)
            assert (json.loads(got["c", n].params), got["c", n].problem, got["c", n].answer) == (one["params"], one["problem"], one["answer"])


def test_pairs_of_a_hot_key_are_dealt_out_and_not_grouped(spark, monkeypatch):
    monkeypatch.setattr(candidates, "CELL", 8)
    rows = [(n, n * 7 % 90, "d", f"t{n % 3}" if n % 11 else None, "hot") for n in range(90)] + [(5, 50, "e", "t1", "hot"), (200, None, "d", "t1", "hot"), (201, 3, None, "t1", None)]
    points = spark.createDataFrame(rows, "node long, position long, domain string, thread string, topic string")
    known = [(1, 2, "x"), (14, 1, "x"), (3, 3, "x"), (5, 6, "x"), (300, 1, "y")]
    routes = spark.createDataFrame(known, "a long, b long, route string")
    want = {(a, b): {r} for a, b, r in known if a != b}
    for x in rows:
        for y in rows:
            if None not in (x[1], y[1]) and x[1] < y[1] and x[0] != y[0]:
                one = None if None in (*x[2:4], *y[2:4]) and not any(p and q and p != q for p, q in zip(x[2:4], y[2:4], strict=True)) else x[2:4] == y[2:4]
                kind = "time_same_thread" if one else "time_same_topic" if one is False and x[4] == y[4] and x[4] else None
                if kind:
                    want.setdefault((x[0], y[0]), set()).add(kind)
    order = ["time_same_thread", "time_same_topic", "x", "y"]
    got = candidates.with_time_pairs(points, [routes])
    assert sorted((r.a, r.b, r.routes) for r in got.collect()) == sorted((*p, ",".join(r for r in order if r in s)) for p, s in want.items())
    key = points.select(F.col("node").alias("a"), F.col("topic").alias("k")), points.select(F.col("node").alias("b"), F.col("topic").alias("k"))
    busy = candidates.met(*key, ["k"]).groupBy(F.spark_partition_id()).count().collect()
    assert len(busy) > 4 and sum(r["count"] for r in busy) == 92 * 92
    left = candidates.non_candidates(points, routes)
    assert "LeftAnti" not in left._jdf.queryExecution().optimizedPlan().toString()
    none = {(1, 2), (14, 1), (5, 6)}
    assert sorted(map(tuple, left.collect())) == sorted((x[0], y[0]) for x in rows for y in rows if None not in (x[1], y[1]) and x[1] < y[1] and x[2] and x[2] == y[2] and (x[0], y[0]) not in none)


def test_nearest_start_equals_the_least_depth_of_all_starts(spark):
    """cycles, loops, starts off the graph, some or all nodes as starts, both ways."""
    for seed in range(3):
        r = random.Random(seed)
        e = spark.createDataFrame([(r.randrange(25), r.randrange(25)) for _ in range(40)], "src long, dst long")
        s = spark.createDataFrame([(n,) for n in (range(30) if seed else range(0, 30, 4))], "start long")
        for backwards in (False, True):
            want = graph.reach(e, s, backwards=backwards, via=False).where("start <> node").groupBy("node").agg(F.min("depth").alias("depth"))
            assert {tuple(x) for x in graph.nearest_start(e, s, backwards).collect()} == {tuple(x) for x in want.collect()}


def test_edges_of_a_walk_are_made_once(spark):
    """the rounds read the edges from a table, and do not make them again."""
    made = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    e = spark.createDataFrame([(n, n + 1) for n in range(6)], "src long, dst long").mapInArrow(seen, "src long, dst long")
    starts = spark.createDataFrame([(0,)], "start long")
    assert graph.reach(e, starts).count() == 6 and made.value == 6


def _largest(df) -> int:
    """Rows of the task that has most."""
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def test_groups_are_backed_off_in_tasks_of_bounded_rows(spark, monkeypatch):
    """adaptive execution gave a task all the more rows the better these compress."""
    monkeypatch.setattr(session, "TASK_ROWS", 200, raising=False)
    rows = spark.range(8000).select((F.col("id") % 2000).alias("k"), (F.col("id") % 3).alias("a"), (F.col("id") % 7).alias("b"))
    assert _largest(grouping.backoff_groups(rows, ["k"], [["a", "b"], ["a"], []])) < 600


def test_levels_that_are_not_nested_and_null_keys_are_backed_off(spark):
    r = random.Random(4)
    data = [(i, *(r.choice((None, "x", "y", "z")) for _ in range(3))) for i in range(60)]
    levels = [["b", "c"], ["c"], ["b"], []]
    want, left = {}, data
    for n, extra in enumerate(levels):
        key = lambda row: (row[1], *(row["iabc".index(c)] for c in extra))  # noqa: B023, E731
        count = Counter(map(key, left))
        done = [row for row in left if count[key(row)] >= 3 or n == 3]
        want |= {row[0]: (3 - n, "|".join(x or "" for x in key(row))) for row in done}
        left = [row for row in left if row[0] not in want]
    got = grouping.backoff_groups(spark.createDataFrame(data, "i int, a string, b string, c string"), ["a"], levels, 3)
    assert {x.i: (x.level, x.group_key) for x in got.collect()} == want


def test_coverage_is_told_in_tasks_of_bounded_rows(spark, monkeypatch):
    """F16: adaptive execution gave a task all the more rows the better these compress."""
    monkeypatch.setattr(session, "TASK_ROWS", 200, raising=False)
    judged = spark.range(2000).select((F.col("id") * 7).alias("item_id"), F.lit("p").alias("point"), F.lit(True).alias("covered"), F.array("id").alias("nodes"))
    points = spark.range(2000).select(F.col("id").alias("node"), F.lit("textbook").alias("provenance"))
    assert _largest(curation.standard_coverage(judged, points, "post")) < 150


def test_coverage_of_both_phases_with_nulls_and_points_told_twice(spark):
    judged = spark.createDataFrame([(1, "b", False, [5, 3, 5]), (1, "a", None, [9, None]), (2, "c", True, None), (None, "d", True, [3])], "item_id int, point string, covered boolean, nodes array<int>")
    points = spark.createDataFrame([(3, "gap"), (3, "textbook"), (5, "gap"), (5, None), (None, "textbook")], "node int, provenance string")
    got = {(r.item_id, r.phase): (r.verdict, r.nodes, r.missing) for r in curation.standard_coverage(judged, points, "pre", "post").collect()}
    part = {(1, "pre"): ("not_covered", [3], "a; b"), (1, "post"): ("not_covered", [3, 5], "a; b")}
    assert got == part | {(k, p): ("covered", [], "") for k in (2, None) for p in ("pre", "post")}


def test_a_worker_gets_few_texts_at_a_time(spark):
    """it got 10,000, and held these and all that was found in them."""
    for name, most in (("maxRecordsPerBatch", "10000"), ("maxBytesPerBatch", "64m")):
        spark.conf.set(f"spark.sql.execution.arrow.{name}", most)
    texts = spark.range(5000).coalesce(1).select(F.lit("red ring").alias("text"))
    found = texts.select(mining.terms_in(F.col("text"), mining.term_forms(["ring"])).alias("f"), F.pandas_udf(lambda t: t.map(lambda _: len(t)), "long")("text").alias("n"))
    assert found.agg(F.max("n"), F.sum(F.size("f"))).first()[:] == (1000, 5000)


def test_singletons_are_attached_in_tasks_of_bounded_rows(spark, monkeypatch):
    """adaptive execution gave a task all the more rows the better these compress."""
    monkeypatch.setattr(session, "TASK_ROWS", 200, raising=False)
    rows = spark.range(8000).select((F.col("id") % 500).alias("k"), "id", F.col("id").cast("string").alias("g"), F.lit("x").alias("d"))
    out = grouping.attached_singletons(rows, ["k"], ["d"], "id", "g")
    assert _largest(out) < 500 and out.where("g = CAST(id AS STRING)").count() == 8000


def test_an_item_alone_in_several_groups_of_a_base_stays_whole(spark):
    """the walk kept one row of an item."""
    data = [(1, "k", "g1", "a"), (2, "k", "g1", "a"), (3, "k", "g2", "b"), (3, "k", "g3", "c"), (4, "q", "h1", "a"), (4, "q", None, "b"), (None, "q", "h2", "b"), (None, "q", "h3", "b")]
    out = grouping.attached_singletons(spark.createDataFrame(data, "id int, base string, g string, d string"), ["base"], ["d"], "id", "g")
    want = [(1, "g1"), (2, "g1"), (3, "g1"), (3, "g1"), (4, "h1"), (4, None), (None, "h2"), (None, "h3")]
    assert Counter(map(tuple, out.collect())) == Counter(want)
