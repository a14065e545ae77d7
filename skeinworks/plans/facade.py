"""Queries of the façade: a curriculum over the stand-in tables, asked through ``Curriculum``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinworks.curriculum import Curriculum
from skeinworks.plans.catalogue import query
from skeinworks.plans.fixtures import frame

#: Places of the stand-ins in the façade's words, as SQL: lessons by name and dense place, points, cards, contexts, glossary.
_PLACES = """place AS (SELECT lesson_id AS okey, concat('g', grade, semester, '.u', unit_id, '.l', lpad(CAST(lesson_id AS VARCHAR), 9, '0')) AS lid, concat('g', grade, semester) AS book, unit_id, grade, semester, position, CAST(row_number() OVER (ORDER BY position) - 1 AS BIGINT) AS n FROM lesson),
    kpoint AS (SELECT concat('kp.', p.node) AS kp_id, p.node, p.name, p.thread, p.domain, p.topic, p.size, p.price, l.lid, l.n, l.grade, l.semester, l.book, l.unit_id AS unit FROM point p JOIN place l ON l.okey = p.lesson_id),
    card AS (SELECT concat('at.', f.item_id) AS card_id, f.item_id, concat('kp.', f.prim) AS primary_id, o.o_orderstatus AS verifiable_type, o.o_orderpriority AS item_form, CAST(1 + f.item_id % 5 AS INTEGER) AS difficulty, l.lid, l.n, l.grade, f.item_id % 4 <> 0 AS sourced FROM first_line f JOIN orders o ON o.o_orderkey = f.item_id JOIN place l ON l.okey = f.item_id),
    here AS (SELECT lid, n FROM place WHERE position = (SELECT min(position) FROM lesson WHERE position >= CAST(30 AS BIGINT) * 1000000000))"""


def _asked(select: str):
    return query(f"WITH {_PLACES} {select}")


def curriculum(spark: SparkSession, sf_dir: str) -> Curriculum:
    """The stand-ins as the façade's tables: orders are lessons and card templates, parts points, customers contexts, part names a glossary."""
    text = lambda c: F.col(c).cast("string")
    lesson = frame(spark, sf_dir, "lesson").withColumn("book", F.concat(F.lit("g"), text("grade"), "semester")).withColumn("unit", text("unit_id"))
    lesson = lesson.withColumn("id", F.concat("book", F.lit(".u"), "unit", F.lit(".l"), F.lpad(text("lesson_id"), 9, "0")))
    names = lesson.select("lesson_id", F.col("id").alias("lid"))
    books = lesson.groupBy("book", "grade", "semester").agg(F.min("book_id").alias("seq_pos")).select(F.col("book").alias("id"), "grade", "semester", F.concat(F.lit("book "), "book").alias("title"), "seq_pos")
    units = lesson.groupBy("unit", "book", "unit_id").agg(F.count(F.lit(1)).alias("n")).select(F.col("unit").alias("id"), F.col("book").alias("book_id"), F.col("unit_id").alias("index"), F.concat(F.lit("unit "), "unit").alias("title"))
    lessons = lesson.select("id", F.col("unit").alias("unit_id"), F.expr("CAST(position div 1000000000 AS INT)").alias("index"), F.concat(F.lit("lesson "), text("lesson_id")).alias("title"), F.lit("").alias("summary"))
    later = frame(spark, sf_dir, "holds").join(names, "lesson_id").groupBy(F.col("kp_id").alias("node")).agg(F.array_sort(F.collect_list("lid")).alias("held"))
    point = frame(spark, sf_dir, "point").join(names, "lesson_id").join(later, "node", "left")  # a left join is dropped where no later lesson is asked for
    points = point.select(
        F.concat(F.lit("kp."), text("node")).alias("id"), "name", F.split("name", " ").alias("aliases"), "domain", "thread", "topic", F.concat_ws(" ", "thread", "domain").alias("description"), F.col("lid").alias("introduced_in"),
        F.array_except("held", F.array("lid")).alias("review_lesson_ids"), (F.col("price") > 1000).alias("is_assessable"), F.lit("aware").alias("mastery"), F.lit("textbook").alias("provenance"),
    )
    item = frame(spark, sf_dir, "first_line").join(frame(spark, sf_dir, "orders"), F.col("item_id") == F.col("o_orderkey")).join(names, F.col("item_id") == F.col("lesson_id"))
    others = frame(spark, sf_dir, "item_ref").groupBy("item_id").agg(F.array_sort(F.collect_set(F.concat(F.lit("kp."), text("other")))).alias("secondary_ids"))
    none = F.array().cast("array<string>")
    cards = item.join(others, "item_id", "left").select(
        F.concat(F.lit("at."), text("item_id")).alias("id"), F.concat(F.lit("kp."), text("prim")).alias("primary_id"), F.coalesce("secondary_ids", none).alias("secondary_ids"), F.col("o_orderstatus").alias("verifiable_type"), F.col("o_orderpriority").alias("item_form"),
        (1 + F.col("item_id") % 5).cast("int").alias("difficulty"), F.when(F.col("item_id") % 4 != 0, F.array(F.concat(F.lit("ex."), "lid", F.lit(".1")))).otherwise(none).alias("source_ids"), F.array(F.concat(F.lit("ctx."), text("o_custkey"))).alias("context_ids"),
        F.lit("{a}+1").alias("template"), F.lit("{}").alias("slots"), none.alias("constraints"), F.lit(None).cast("string").alias("solver"), F.lit(None).cast("string").alias("answer"),
    )
    edge = frame(spark, sf_dir, "edge")
    edges = edge.select(F.concat_ws(".", F.lit("e"), "type", "src", "dst").alias("id"), "type", F.concat(F.lit("kp."), text("src")).alias("src"), F.concat(F.lit("kp."), text("dst")).alias("dst"), F.lit(True).alias("is_direct"), F.lit(1.0).alias("confidence"))
    customer = frame(spark, sf_dir, "customer").join(frame(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    contexts = customer.select(F.concat(F.lit("ctx."), text("c_custkey")).alias("id"), F.col("c_mktsegment").alias("theme"), F.array("n_name").alias("variants"), F.array("c_name").alias("quantities"), F.when(F.col("c_custkey") % 7 == 0, F.array().cast("array<int>")).otherwise(F.array((F.col("c_custkey") % 7).cast("int"))).alias("grades"))
    part = frame(spark, sf_dir, "part").groupBy("p_name").agg(F.min("p_partkey").alias("k"), F.min("p_type").alias("alias"))
    glossary = part.select(F.col("p_name").alias("term"), F.array(F.lower("alias")).alias("aliases"), F.lit("").alias("definition"), F.col("k").cast("int").alias("seq"))
    cur = Curriculum(spark, {"books": books, "units": units, "lessons": lessons, "points": points, "cards": cards, "edges": edges, "contexts": contexts, "glossary": glossary})
    return cur


def _lesson(spark: SparkSession, sf_dir: str) -> str:
    """The first lesson of day 30 or later."""
    row = frame(spark, sf_dir, "lesson").where(F.col("position") >= 30 * 10**9).agg(F.min_by(F.struct("grade", "semester", "unit_id", "lesson_id"), "position").alias("x")).first().x
    return f"g{row.grade}{row.semester}.u{row.unit_id}.l{row.lesson_id:09d}"


@_asked("SELECT k.kp_id, k.name, k.thread, k.lid AS introduced_in, k.n AS position FROM kpoint k, here WHERE k.n < here.n")
def learned_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum(spark, sf_dir).learned_before(_lesson(spark, sf_dir)).select("kp_id", "name", "thread", "introduced_in", "position")


@_asked("SELECT k.kp_id, k.n AS position FROM kpoint k, here WHERE k.n <= here.n AND k.domain = 'PROMO' AND k.grade = 1")
def learned_in_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum(spark, sf_dir).learned_before(_lesson(spark, sf_dir), inclusive=True, domain="PROMO", grade=1).select("kp_id", "position")


@_asked("SELECT k.kp_id, k.name FROM kpoint k, here WHERE k.n > here.n")
def not_yet_learned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum(spark, sf_dir).not_yet_learned(_lesson(spark, sf_dir)).select("kp_id", "name")


@_asked("SELECT kp_id, name FROM kpoint WHERE name = 'bolt' OR list_contains(string_split(name, ' '), 'bolt')")
def find_by_name_or_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum(spark, sf_dir).find_kp(" bolt ").select(F.col("id").alias("kp_id"), "name")


@_asked("SELECT kp_id, name, n AS position FROM kpoint WHERE grade = 1 AND domain = 'PROMO' AND book = 'g1a' AND price > 1000")
def kp_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum(spark, sf_dir).kps(grade=1, domain="PROMO", book="g1a", assessable=True).select("kp_id", "name", "position")


@_asked("SELECT kp_id, name FROM kpoint WHERE kp_id IN (SELECT primary_id FROM card WHERE verifiable_type = 'P')")
def kp_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum(spark, sf_dir).kps(verifiable_type="P").select("kp_id", "name")


@_asked("SELECT kp_id AS id, name, lid AS introduced_in FROM kpoint WHERE node = (SELECT min(node) FROM point)")
def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = frame(spark, sf_dir, "point").agg(F.min("node").alias("n")).first().n
    row = curriculum(spark, sf_dir).kp(f"kp.{first}")
    return spark.createDataFrame([(row.id, row.name, row.introduced_in)], "id string, name string, introduced_in string")


@_asked("SELECT kp_id, concat('book ', book, ' / unit ', unit, ' / lesson ', CAST(right(lid, 9) AS BIGINT)) AS label, grade, semester, n AS position FROM kpoint")
def locate_denormalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum(spark, sf_dir).located().select("kp_id", "label", "grade", "semester", "position")


@_asked("SELECT lid AS lesson_id FROM place WHERE book = 'g3a' AND unit_id = 199703")
def lessons_of_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum(spark, sf_dir).lessons_of(book="g3a", unit="199703")


@_asked("SELECT lid AS lesson_id, n AS position, CAST(unit_id AS VARCHAR) AS unit_id, grade FROM place")
def lesson_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum(spark, sf_dir).places().select("lesson_id", "position", "unit_id", "grade")


_GRADES = "c.card_id AS id, CASE WHEN c.sourced THEN CAST(c.grade AS VARCHAR) ELSE coalesce(CAST(k.grade AS VARCHAR), '') END AS grades"


@_asked("SELECT c.card_id AS id, c.primary_id, c.difficulty FROM card c LEFT JOIN kpoint k ON k.kp_id = c.primary_id WHERE c.difficulty BETWEEN 2 AND 4 AND k.domain = 'SMALL' AND c.verifiable_type = 'F' AND CASE WHEN c.sourced THEN c.grade ELSE k.grade END = 3")
def archetype_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum(spark, sf_dir).archetypes(domain="SMALL", grade=3, verifiable_type="F", difficulty=(2, 4)).select("id", "primary_id", "difficulty")


@_asked("SELECT DISTINCT c.card_id AS id FROM card c LEFT JOIN item_ref r ON r.item_id = c.item_id WHERE c.primary_id = concat('kp.', (SELECT min(node) FROM point)) OR r.other = (SELECT min(node) FROM point)")
def archetypes_with_secondary(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = frame(spark, sf_dir, "point").agg(F.min("node").alias("n")).first().n
    return curriculum(spark, sf_dir).archetypes(kp_id=f"kp.{first}", include_secondary=True).select("id")


@_asked(f"SELECT {_GRADES} FROM card c LEFT JOIN kpoint k ON k.kp_id = c.primary_id")
def archetype_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum(spark, sf_dir).card_grades().select("id", F.array_join(F.col("grades").cast("array<string>"), ",").alias("grades"))


@_asked("SELECT c.card_id, CASE WHEN c.sourced THEN c.lid ELSE k.lid END AS lessons FROM card c LEFT JOIN kpoint k ON k.kp_id = c.primary_id")
def archetype_lessons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum(spark, sf_dir).archetype_lessons().select("card_id", F.array_join("lessons", ",").alias("lessons"))


@_asked("SELECT concat('ctx.', c_custkey) AS id, c_mktsegment AS theme FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE (c_custkey % 7 = 0 OR c_custkey % 7 = 2) AND contains(concat_ws(' ', c_mktsegment, n_name, c_name), 'TION_1')")
def context_text_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum(spark, sf_dir).contexts(grade=2, text="TION_1").select("id", "theme")


@_asked("SELECT concat('ctx.', c_custkey) AS id, c_mktsegment AS theme FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey = (SELECT min(item_id) FROM first_line)")
def contexts_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = frame(spark, sf_dir, "first_line").agg(F.min("item_id").alias("n")).first().n
    return curriculum(spark, sf_dir).contexts_for(f"at.{first}").select("id", "theme")


@_asked("SELECT p_name AS term, CAST(min(p_partkey) AS INTEGER) AS seq FROM part GROUP BY p_name HAVING p_name = 'small ring' OR lower(min(p_type)) = 'small ring'")
def glossary_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum(spark, sf_dir).glossary("small ring").select("term", "seq")


@_asked("SELECT p_name AS term, CAST(min(p_partkey) AS INTEGER) AS seq FROM part GROUP BY p_name HAVING contains('the small ring and red widget of promo', p_name) OR contains('the small ring and red widget of promo', lower(min(p_type)))")
def glossary_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum(spark, sf_dir).glossary_search("the small ring and red widget of promo").select("term", "seq")


@_asked("SELECT concat('kp.', src) AS kp_id, 'prerequisite' AS type, concat('kp.', dst) AS other, 'out' AS direction FROM edge WHERE src = (SELECT min(src) FROM edge) UNION ALL SELECT concat('kp.', dst), 'prerequisite', concat('kp.', src), 'in' FROM edge WHERE dst = (SELECT min(src) FROM edge)")
def relations_of_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = frame(spark, sf_dir, "edge").agg(F.min("src").alias("n")).first().n
    return curriculum(spark, sf_dir).relations(f"kp.{first}", types=("prerequisite",))


@query(f"WITH RECURSIVE {_PLACES}, e AS (SELECT DISTINCT dst AS src, src AS dst FROM edge), walk(node, depth) AS (SELECT max(src), 0 FROM e UNION SELECT e.dst, w.depth + 1 FROM walk w JOIN e ON w.node = e.src) SELECT concat('kp.', node) AS kp_id, CAST(min(depth) AS INTEGER) AS depth FROM walk WHERE depth > 0 GROUP BY node")
def prerequisites_of_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = frame(spark, sf_dir, "edge").agg(F.max("dst").alias("n")).first().n
    return curriculum(spark, sf_dir).prerequisites(f"kp.{last}").select("kp_id", "depth")
