"""Queries over whole tables, held against brute force on a small fixture."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from skeinworks.plans.catalogue import QUERIES

LONG = "alpha Beta " * 300
DOCS = [(1, "One fish, two fish", "en"), (2, "un pez, dos peces", "es"), (3, "ein Fisch 2.5", "de"), (4, "one red fish", None), (5, LONG, "en"), (6, None, "en")]


def documents(spark, folder):
    rows = [(i, t, lang, "web", len(t or "")) for i, t, lang in DOCS]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def counted(grams):
    n, df = Counter(), Counter()
    for text in (t or "" for _, t, _ in DOCS):
        found = grams(text)
        n.update(found)
        df.update(set(found))
    return {(g, n[g], df[g]) for g in n}


def words(text):
    return re.findall(r"[a-z]+|\d+(?:\.\d+)?", text.lower())


def test_token_counts_cover_every_document(spark, tmp_path):
    sf = documents(spark, tmp_path)
    got = {name: {(r.token, r.n, r.df) for r in QUERIES[name](spark, sf).collect()} for name in ("word_tokens", "bigram_tokens")}
    assert got["word_tokens"] == counted(words)
    assert got["bigram_tokens"] == counted(lambda t: [(s := re.sub(r"\s+", "", t))[i : i + 2] for i in range(len(re.sub(r"\s+", "", t)) - 1)])


def test_normal_terms_cover_every_document(spark, tmp_path):
    got = {(r.doc_id, r.term) for r in QUERIES["normal_terms"](spark, documents(spark, tmp_path)).collect()}
    assert got == {(i, t if t is None else re.sub(r"[^a-z0-9]+", "", t.lower())) for i, t, _ in DOCS}


def test_tfidf_covers_every_document(spark, tmp_path):
    sf = documents(spark, tmp_path)
    tf = {i: Counter(words(t or "")) for i, t, _ in DOCS}
    df = Counter(w for c in tf.values() for w in c)
    raw = {i: {w: (1 + math.log(n)) * (math.log((1 + len(tf)) / (1 + df[w])) + 1) for w, n in c.items()} for i, c in tf.items()}
    unit = {i: {w: x / math.sqrt(sum(y * y for y in c.values())) for w, x in c.items()} for i, c in raw.items()}
    got = {(r.doc_id, r.token): r.w for r in QUERIES["tfidf_weights"](spark, sf).collect()}
    assert got.keys() == {(i, w) for i, c in unit.items() for w in c}
    assert all(abs(x - unit[i][w]) < 2e-6 for (i, w), x in got.items())
    sims = {(a, b): sum(unit[a][w] * unit[b][w] for w in unit[a].keys() & unit[b].keys()) for a in unit for b in unit if a < b and unit[a].keys() & unit[b].keys()}
    pairs = {(r.a, r.b): r.sim for r in QUERIES["tfidf_pairs"](spark, sf).collect()}
    assert pairs.keys() == sims.keys() and all(abs(x - sims[p]) < 2e-6 for p, x in pairs.items())
    assert {(r.a, r.b) for r in QUERIES["tfidf_topk"](spark, sf).collect()} == sims.keys()


SMALL = "/root/testdata/sf0.001"


def test_every_line_is_checked_against_the_lesson_before(spark):
    facts = spark.read.parquet(f"{SMALL}/lineitem.parquet").join(spark.read.parquet(f"{SMALL}/orders.parquet"), F.col("l_orderkey") == F.col("o_orderkey"))
    lines = facts.selectExpr("o_orderdate", "l_orderkey", "l_linenumber", "CAST(l_quantity AS LONG) AS need", "l_returnflag AS op", "concat(l_linestatus, l_linenumber) AS token").collect()
    orders = sorted((r.o_orderdate, r.o_orderkey) for r in spark.read.parquet(f"{SMALL}/orders.parquet").select("o_orderdate", "o_orderkey").collect())
    place = {k: i for i, (_, k) in enumerate(orders)}
    first, reached = {}, {}
    for r in lines:
        first[r.op, r.token] = min(first.get((r.op, r.token), len(orders)), place[r.l_orderkey])
        reached[r.need] = min(reached.get(r.need, len(orders)), place[r.l_orderkey])
    items = {}
    for r in lines:
        here = max(place[r.l_orderkey] - 1, 0)
        need, flags = items.setdefault((r.l_orderkey * 10 + r.l_linenumber, orders[here][1], here), ([], set()))
        need.append(r.need)
        flags.add((r.op, r.token))
    want = {}
    for (item, lesson, here), (need, flags) in items.items():
        late = min(p for n, p in reached.items() if n >= max(need)) > here
        want[item, lesson] = late + sum(first[f] > here for f in flags)
    got = {(r.item_id, r.lesson_id): r.n_violations for r in QUERIES["check_verdict"](spark, SMALL).collect()}
    assert len(got) == len({(r.l_orderkey, r.l_linenumber) for r in lines}) and got == want
    assert QUERIES["check_item"](spark, SMALL).count() == sum(want.values()) > 0


def test_points_of_every_size_are_coded_and_reviewed(spark):
    from skeinworks.plans.fixtures import frame

    order = [r.node for r in sorted(frame(spark, SMALL, "point").select("node", "position").collect(), key=lambda r: (r.position, r.node))]
    assert {(r.node, r.code) for r in QUERIES["screening_codes"](spark, SMALL).collect()} == {(n, f"K{i:03d}") for i, n in enumerate(order)}
    position = {r.node: r.position for r in frame(spark, SMALL, "point").select("node", "position").collect()}
    want = {(r.src, 1, position[r.src]) for r in frame(spark, SMALL, "edge").collect() if position[r.src] < 900 * 10**9}
    assert {(r.node, r.depth, r.position) for r in QUERIES["review_candidates"](spark, SMALL).collect()} == want


def test_pairs_of_whole_topics_and_domains(spark):
    from skeinworks.plans.fixtures import frame

    points = frame(spark, SMALL, "point").select("node", "position", "domain", "thread", "topic").collect()
    edges = {(r.src, r.dst) for r in frame(spark, SMALL, "edge").collect()}
    thread, topic, domain = set(), set(), set()
    for a in points:
        for b in points:
            if a.position < b.position:
                same = (a.domain, a.thread) == (b.domain, b.thread)
                (thread if same else topic if a.topic == b.topic else set()).add((a.node, b.node))
                if a.domain == b.domain and (a.node, b.node) not in edges:
                    domain.add((a.node, b.node))
    found = [(r.a, r.b, r.route) for r in QUERIES["theta_self_join"](spark, SMALL).collect()]
    assert len(found) == len(set(found)) and set(found) == {(*p, "time_same_thread") for p in thread} | {(*p, "time_same_topic") for p in topic}
    routes = {(r.a, r.b): r.routes for r in QUERIES["route_union_candidates"](spark, SMALL).collect()}
    assert {p for p, x in routes.items() if "time_same_topic" in x} == topic and {p for p, x in routes.items() if "time_same_thread" in x} == thread
    assert edges <= routes.keys()
    got = [(r.a, r.b) for r in QUERIES["non_candidates"](spark, SMALL).collect()]
    assert len(got) == len(set(got)) and set(got) == domain


def test_overlap_of_long_items(spark, tmp_path):
    head = "".join(f"{i:05d}" for i in range(100))
    texts = {1: head + "one tail of it", 2: head + "another tail", 3: "x" * 500 + "one tail of it", 4: "short"}
    spark.createDataFrame(list(texts.items()), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    grams = {i: {s[k : k + 5] for k in range(len(s) - 4)} for i, t in texts.items() for s in [t.replace(" ", "")]}
    want = {(a, b): round(len(grams[a] & grams[b]) / len(grams[a]), 6) for a in grams for b in grams if a < b and grams[a] & grams[b]}
    assert (1, 3) in want
    assert {(r.item_id, r.other): r.overlap for r in QUERIES["ngram_overlap"](spark, str(tmp_path)).collect()} == want


def test_exercises_in_bounds_are_in_by_the_whole_check(spark):
    """Verdicts by snapshot against ``check_items``, for lessons before, at and after what a card needs."""
    import json

    from skeinworks.functions.generate import instantiate_within, params_features
    from skeinworks.operators import lattice

    slots = {"a": {"type": "int", "min": 1, "max": 60}, "d": {"type": "decimal", "min": "0.1", "max": "3", "places": 2}, "f": {"type": "fraction", "min": "0", "max": "3", "max_denominator": 5}}
    lessons = spark.createDataFrame([(f"l{i}", i, f"u{i // 4}") for i in range(16)], "lesson_id string, position int, unit_id string")
    facts = [("integer_domain", None, None, 5, 0), ("integer_domain", None, None, 20, 6), ("integer_domain", None, None, 60, 9), ("integer_domain", None, None, 10, 12), ("decimal_places", None, None, 1, 3), ("decimal_places", None, None, 2, 5)]
    facts += [("fraction_types", None, "几分之一", None, 2), ("fraction_types", None, "假分数", None, 7), ("fraction_types", None, "带分数", None, 11), ("concepts", None, "面积", None, 1)]
    facts = spark.createDataFrame(facts, "dimension string, op string, token string, num long, position int")
    card = json.dumps({"template": "{a}{d}{f}", "slots": slots, "constraints": ["a > 3"]})
    rows = spark.createDataFrame([(f"c{s}", card, s, f"l{i}") for i in range(16) for s in range(6)] + [("c0", card, 0, "nowhere"), ("c1", card, 1, None)], "card_id string, card string, seed long, lesson_id string")
    bounds = lattice.snapshots(facts, lessons)
    made = instantiate_within(rows, bounds, only_in_bounds=False).collect()
    strict = instantiate_within(rows, bounds).collect()
    soft = instantiate_within(rows, bounds, accept_borderline=True).collect()
    assert {r.error for r in made if r.lesson_id in (None, "nowhere")} == {"UnknownLesson"} and len(made) == len(rows.collect())
    needs = []
    for n, r in enumerate([*made, *strict, *soft]):
        if r.error is None:
            f = params_features(json.loads(r.params), slots)
            needs += [(n, r.lesson_id, d, None, None, v) for d, v in (("integer_domain", f["integer_max"]), ("decimal_places", f["decimal_places"])) if v] + [(n, r.lesson_id, "fraction_types", None, t, None) for t in f["fraction_types"]]
    _, reports = lattice.check_items(spark.createDataFrame(needs, "item_id long, lesson_id string, dimension string, op string, token string, need long"), facts, lessons)
    want = {r.item_id: r.verdict for r in reports.collect()}
    assert set(want.values()) == {"in", "borderline", "out"}
    for n, r in enumerate([*made, *strict, *soft]):
        assert r.error is not None or r.verdict == want.get(n, "in")
    assert {r.verdict for r in strict} == {"in", None} and {r.verdict for r in soft} == {"in", "borderline", None}
    assert any(r.error == "NoInBounds" for r in strict)
    # An error row means that no draw of the seed's stream is in bounds.
    from skeinworks.functions.generate import NoInBounds, instantiate

    by = {r.lesson_id: r.asDict() for r in bounds.collect()}
    refused = next(r for r in strict if r.error == "NoInBounds")
    with pytest.raises(NoInBounds):
        instantiate(json.loads(card), refused.seed, 50, by[refused.lesson_id], ("in",))


def test_boundary_at_meets_no_nested_loop(spark):
    from skeinworks.operators import lattice

    facts = spark.createDataFrame([("d", None, f"t{i}", None, (i * 7) % 50) for i in range(40)] + [("d", None, "t0", None, 9)], "dimension string, op string, token string, num long, position int")
    asked = spark.createDataFrame([(p,) for p in (-1, 0, 3, 3, 20, 49, 80, None)], "position int")
    out = lattice.boundary_at(facts, asked)
    assert "NestedLoop" not in out._jdf.queryExecution().toString() and "CartesianProduct" not in out._jdf.queryExecution().toString()
    want = sorted((p, f"t{i}") for p in (0, 3, 20, 49, 80) for i in range(40) if (i * 7) % 50 <= p)
    assert sorted((r.position, r.token) for r in out.collect()) == want
    assert lattice.boundary_at(facts, asked.limit(0)).count() == 0


def test_mined_columns_equal_their_functions(spark, tmp_path):
    from skeinworks.functions import mining
    from skeinworks.plans.texts import UNITS

    texts = ["3+4×5=23，走5 km", "一条7角形，5角钱，8时间", "1/2又3又1/4", None, "", "fisheyes two-fish peces, alphabet", "10÷4=2.5 30° 5cm " * 4000]
    rows = [(i, t, None, "web", 0) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "alphabet fisheyes"), (2, None), (3, "twofish")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: r for r in QUERIES["mined_numbers"](spark, str(tmp_path)).collect()}
    units = mining.Matcher(mining.unit_forms(UNITS))
    import json

    for i, t in enumerate(texts):
        if t is None:
            assert got[i].operations is None and got[i].units is None
        else:
            assert [(o["op"], o["left"], o["right"], o.get("mode")) for o in json.loads(got[i].operations)] == mining.mine_operations(t)
            assert got[i].units == ",".join(mining.mine_units(t, units)) and got[i].fraction_types == ",".join(mining.mine_fraction_types(t))
    found = {r.doc_id: r.terms for r in QUERIES["mined_terms"](spark, str(tmp_path)).collect()}
    assert found[5] == "alphabet,fisheyes,twofish" and found[0] == "" and found[3] is None


def test_reports_leave_nothing_out(spark):
    from skeinworks.sources import files

    df = spark.range(5).toDF("n")
    assert files.json_payload(df, ["n"], most=5).count("{") == 5 and files.markdown_table(df, ["n"], most=5).count("\n") == 6
    for report in (files.json_payload, files.markdown_table):
        with pytest.raises(ValueError, match="more than 4"):
            report(df, ["n"], most=4)
