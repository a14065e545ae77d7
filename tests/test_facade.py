"""The facade over a small curriculum, files and streaming."""

import json

import pytest
from pyspark.sql import functions as F

from skeinworks.curriculum import SCHEMAS, Curriculum
from skeinworks.functions.generate import NoInBounds
from skeinworks.sources import files
from skeinworks.streaming import introductions

DATA = {
    "books": [{"id": "g1a", "grade": 1, "semester": "a", "title": "一上", "seq_pos": 0}, {"id": "g1b", "grade": 1, "semester": "b", "title": "一下", "seq_pos": 1}],
    "units": [{"id": "g1a.u1", "book_id": "g1a", "index": 1, "title": "加法"}, {"id": "g1b.u1", "book_id": "g1b", "index": 1, "title": "图形"}],
    "lessons": [{"id": "g1b.u1.l01", "unit_id": "g1b.u1", "index": 1, "title": "三角形"}, {"id": "g1a.u1.l02", "unit_id": "g1a.u1", "index": 2, "title": "进位加法"}, {"id": "g1a.u1.l01", "unit_id": "g1a.u1", "index": 1, "title": "加法"}],
    "points": [
        {"id": "kp.na.add.one", "name": "十以内加法", "aliases": ["加法"], "domain": "na", "thread": "add", "topic": "加法", "description": "十以内的加法", "introduced_in": "g1a.u1.l01", "review_lesson_ids": ["g1b.u1.l01"], "is_assessable": True},
        {"id": "kp.na.add.two", "name": "进位加法", "aliases": [], "domain": "na", "thread": "add", "topic": "加法", "description": "二十以内进位加法", "introduced_in": "g1a.u1.l02", "review_lesson_ids": [], "is_assessable": True},
        {"id": "kp.gg.shape.tri", "name": "三角形", "aliases": [], "domain": "gg", "thread": "shape", "topic": "图形", "description": "认识三角形", "introduced_in": "g1b.u1.l01", "review_lesson_ids": [], "is_assessable": False},
    ],
    "cards": [{"id": "at.add.01", "primary_id": "kp.na.add.two", "secondary_ids": ["kp.na.add.one"], "verifiable_type": "program", "item_form": "calc", "difficulty": 2, "source_ids": ["ex.g1a.u1.l02.01"], "context_ids": ["ctx.b", "ctx.a"],
               "template": "{a}+{b}={ans}", "slots": json.dumps({"a": {"type": "int", "min": 1, "max": 9}, "b": {"type": "int", "min": 1, "max": 9}}), "constraints": ["a + b > 10"], "answer": "a+b"}],
    "edges": [{"id": "e1", "type": "prerequisite", "src": "kp.na.add.one", "dst": "kp.na.add.two", "is_direct": True}, {"id": "e2", "type": "prerequisite", "src": "kp.na.add.one", "dst": "missing", "is_direct": True}, {"id": "e3", "type": "related", "src": "kp.na.add.one", "dst": "kp.gg.shape.tri"}],
    "contexts": [{"id": "ctx.a", "theme": "购物", "variants": ["买菜"], "quantities": ["元"], "grades": []}, {"id": "ctx.b", "theme": "行程", "variants": [], "quantities": [], "grades": [2]}],
    "glossary": [{"term": "角", "aliases": [], "seq": 0}, {"term": "三角形", "aliases": ["三边形"], "seq": 1}],
    "facts": [{"dimension": "integer_domain", "num": 10, "position": 0}, {"dimension": "operation_forms", "op": "加法", "token": "进位", "position": 1}],
}


@pytest.fixture(scope="module")
def cur(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("data")
    for name, rows in DATA.items():
        (folder / f"{name}.json").write_text(json.dumps(rows, ensure_ascii=False), encoding="utf-8")
    return Curriculum.load(spark, str(folder))


def ids(df, column="kp_id"):
    return [r[column] for r in df.collect()]


def test_sequence_and_lookups(cur):
    assert ids(cur.lesson_ids(), "lesson_id") == ["g1a.u1.l01", "g1a.u1.l02", "g1b.u1.l01"]
    assert cur.lesson_position("g1b.u1.l01") == 2 and cur.locate("kp.gg.shape.tri").label == "一下 / 图形 / 三角形"
    assert ids(cur.find_kp(" 加法 "), "id") == ["kp.na.add.one"] and ids(cur.kps(domain="na")) == ["kp.na.add.one", "kp.na.add.two"] and ids(cur.kps(verifiable_type="program")) == ["kp.na.add.two"]
    assert ids(cur.lessons_of(book="g1a"), "lesson_id") == ["g1a.u1.l01", "g1a.u1.l02"]
    for call in (lambda: cur.kp("x"), lambda: cur.lesson_position("x"), lambda: cur.archetype("x"), lambda: cur.context("x")):
        with pytest.raises(KeyError):
            call()


def test_learned_and_graph(cur):
    assert ids(cur.learned_before("g1a.u1.l02")) == ["kp.na.add.one"] and ids(cur.not_yet_learned("g1a.u1.l02")) == ["kp.gg.shape.tri"]
    assert [(r.kp_id, r.depth, r.via) for r in cur.prerequisites("kp.na.add.two").collect()] == [("kp.na.add.one", 1, "kp.na.add.two")]
    assert ids(cur.dependents("kp.na.add.one")) == ["kp.na.add.two"]
    assert [(r.other, r.direction) for r in cur.relations("kp.gg.shape.tri").collect()] == [("kp.na.add.one", "in")]
    assert ids(cur.review_candidates("g1b.u1.l01", ["kp.na.add.two"])) == ["kp.na.add.one"] and ids(cur.review_candidates("g1b.u1.l01")) == ["kp.na.add.two", "kp.na.add.one"]


def test_cards_contexts_glossary(cur):
    assert ids(cur.archetypes("kp.na.add.one", include_secondary=True), "id") == ["at.add.01"] and ids(cur.archetypes("kp.na.add.one"), "id") == [] and ids(cur.archetypes(grade=1, difficulty=(1, 2)), "id") == ["at.add.01"]
    assert cur.archetype_lessons().first().lessons == ["g1a.u1.l02"]
    assert ids(cur.contexts(grade=1), "id") == ["ctx.a"] and ids(cur.contexts(text="买菜"), "id") == ["ctx.a"] and ids(cur.contexts_for("at.add.01"), "id") == ["ctx.b", "ctx.a"]
    assert ids(cur.glossary_search("直角三角形"), "term") == ["三角形", "角"] and ids(cur.glossary("三边形"), "term") == ["三角形"]


def test_search_boundary_generation(cur):
    hits = cur.search("进位加法").collect()
    assert hits[0].kp_id == "kp.na.add.two" and all(h.score > 0 for h in hits)
    assert ids(cur.search("进位加法", domain="gg")) == [] and ids(cur.search("一年级数与代数综合卷", filler=("综合卷",))) == ["kp.na.add.one", "kp.na.add.two"]
    assert {(r.dimension, r.token) for r in cur.boundary("g1a.u1.l02").collect()} == {("operation_forms", "进位")}
    made = cur.instantiate_many("at.add.01", 5).collect()
    assert len(made) == 5 and len({r.params for r in made}) == 5 and all(int(r.answer) > 10 for r in made)
    assert cur.instantiate("at.add.01", 3).problem == cur.instantiate("at.add.01", 3).problem
    with pytest.raises(ValueError):
        cur.instantiate("at.add.01", 0, only_in_bounds=True)
    with pytest.raises(KeyError):
        cur.instantiate("at.add.01", 0, "no.such.lesson")
    first, small = "g1a.u1.l01", Curriculum(cur.spark, cur.t | {"facts": cur.t["facts"].withColumn("num", F.lit(2).cast("long"))})
    with pytest.raises(NoInBounds):
        small.instantiate("at.add.01", 0, first, only_in_bounds=True, max_tries=5)
    assert small.instantiate("at.add.01", 0, first).verdict == "out" and all(r.verdict == "in" for r in cur.instantiate_many("at.add.01", 3, lesson_id=first, only_in_bounds=True).collect())
    assert cur.instantiate("at.add.01", 0, first).verdict == "in"


def test_empty_knowledge_base(spark):
    cur = Curriculum(spark, {})
    assert set(cur.t) == set(SCHEMAS) and cur.kps().count() == 0 and cur.search("x").count() == 0


def test_files(spark, tmp_path):
    assert files.read_jsonl(spark, str(tmp_path / "none.jsonl"), "a int").count() == 0
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    assert files.read_jsonl(spark, str(tmp_path / "x.jsonl"), "a int").count() == 2
    (tmp_path / "p.md").write_text("| id | kind | query |\n|---|---|---|\n| P01 | variant | 加法 题 |\n")
    assert [tuple(r) for r in files.read_probes(spark, str(tmp_path / "p.md")).collect()] == [("P01", "variant", "加法 题")]
    (tmp_path / "s.yaml").write_text("items:\n  - id: a1\n    text: 'x'\n  - id: a2\n")
    assert {(r.id, r.text) for r in files.read_yaml_items(spark, str(tmp_path / "s.yaml")).collect()} == {("a1", "x"), ("a2", None)}
    folder = tmp_path / "d"
    folder.mkdir()
    (folder / "a.json").write_bytes(b"[]\r\n")
    actual = files.file_entries(spark, str(folder))
    assert actual.first().bytes == 3
    listed = actual.union(spark.createDataFrame([("b.json", 1, "x")], actual.schema))
    assert [tuple(r) for r in files.verify_manifest(listed, actual).collect()] == [("b.json", "missing")]
    with pytest.raises(ValueError):
        files.check_compatible("2.0")
    texts = spark.createDataFrame([("a",), ("b",), ("a",)], "text string")
    cached = texts.where("text = 'a'").limit(1).select(files.text_key("m", F.col("text")).alias("text_hash"), F.array(F.lit(3.0), F.lit(4.0)).cast("array<float>").alias("vec"))

    def fetch(batch):
        assert batch == ["b"]
        return [[0.0, 2.0]]

    got = sorted(tuple(round(x, 3) for x in r.vec) for r in files.embedded(texts, cached, "m", fetch).collect())
    assert got == [(0.0, 1.0), (0.6, 0.8)]


def test_streaming_introductions(spark, tmp_path):
    schema = "dimension string, op string, token string, num long, position long"
    source = tmp_path / "in"
    spark.createDataFrame([("d", "o", "t", None, 5), ("d", "o", "u", None, 7)], schema).write.parquet(str(source))
    spark.createDataFrame([("d", "o", "t", None, 2)], schema).write.mode("append").parquet(str(source))
    stream = introductions.start_introductions(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source)), str(tmp_path / "out"), str(tmp_path / "ck"))
    stream.processAllAvailable()
    stream.stop()
    final = spark.read.parquet(str(tmp_path / "out")).groupBy("token").agg(F.min("position").alias("p"))
    assert {tuple(r) for r in final.collect()} == {("t", 2), ("u", 7)}
