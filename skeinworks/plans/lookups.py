"""Look-ups, sequences, set operations, joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinworks.operators import candidates, curation, graph, reports, sequence
from skeinworks.plans.catalogue import query
from skeinworks.plans.fixtures import frame
from skeinworks.sources.files import verify_manifest


@query("SELECT domain, grade, CAST(count_if(position < CAST(900 AS BIGINT) * 1000000000) AS BIGINT) AS before, CAST(count_if(position >= CAST(900 AS BIGINT) * 1000000000) AS BIGINT) AS after FROM point GROUP BY domain, grade")
def learned_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.parted_by_lesson(frame(spark, sf_dir, "point"), 900 * 10**9)


@query("SELECT d.doc_id, t.term FROM documents d JOIN (SELECT DISTINCT r_name AS term FROM region UNION SELECT DISTINCT lower(n_name) FROM nation UNION SELECT DISTINCT split_part(p_name, ' ', 1) FROM part) t ON contains(d.text, t.term)")
def glossary_reverse_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = frame(spark, sf_dir, "region").select(F.col("r_name").alias("term")).union(frame(spark, sf_dir, "nation").select(F.lower("n_name"))).union(frame(spark, sf_dir, "part").select(F.split("p_name", " ")[0]))
    return reports.occurring_terms(frame(spark, sf_dir, "documents"), "doc_id", "text", terms, "term")


@query("SELECT node, grade, domain FROM point WHERE grade IN (1, 3, 5) AND domain IN ('LARGE', 'MEDIUM') AND size BETWEEN 5 AND 25")
def facet_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.facets(frame(spark, sf_dir, "point"), {"grade": [1, 3, 5], "domain": ["LARGE", "MEDIUM"]}, {"size": (5, 25)}).select("node", "grade", "domain")


@query("SELECT lang, CAST(count_if(regexp_matches(text, '[0-9]{3}')) AS BIGINT) AS hits, count(*) AS n FROM documents GROUP BY lang")
def unreadable_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.matching_share(frame(spark, sf_dir, "documents"), "lang", "text", "[0-9]{3}")


@query("SELECT lesson_id, row_number() OVER (ORDER BY position) - 1 AS place FROM lesson")
def lesson_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.dense_position(frame(spark, sf_dir, "lesson"), ["position"], "place").select("lesson_id", "place")


@query("SELECT kp_id, position, last_position FROM first_seen")
def intro_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.first_and_last(frame(spark, sf_dir, "holds"), frame(spark, sf_dir, "lesson"))


@query("SELECT h.kp_id, count(*) - 1 AS reviews, max(l.grade) AS last_grade FROM holds h JOIN lesson l ON h.lesson_id = l.lesson_id GROUP BY h.kp_id")
def review_lessons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.review_span(frame(spark, sf_dir, "holds"), frame(spark, sf_dir, "lesson"))


@query("SELECT * FROM (SELECT thread, domain, node AS a, lead(node) OVER (PARTITION BY thread, domain ORDER BY position, node) AS b FROM point) WHERE b IS NOT NULL")
def thread_lead(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.adjacent_pairs(frame(spark, sf_dir, "point"), ["thread", "domain"], ["position", "node"], "node")


@query("SELECT thread, node, place FROM (SELECT thread, node, CAST(row_number() OVER (PARTITION BY thread ORDER BY price DESC, node) AS INTEGER) AS place FROM point) WHERE place <= 5")
def top_per_thread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.top_per_group(frame(spark, sf_dir, "point"), ["thread"], [F.desc("price"), "node"], 5).select("thread", "node", "place")


@query("""
    WITH c AS (SELECT user_id, event_id, event_type, CASE WHEN event_type = lag(event_type) OVER w THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
         r AS (SELECT user_id, event_id, event_type, CAST(sum(fresh) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM c)
    SELECT user_id, island, event_type, min(event_id) AS first_at, max(event_id) AS last_at, count(*) AS length FROM r GROUP BY user_id, island, event_type""")
def run_length_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.islands(frame(spark, sf_dir, "events"), ["user_id"], ["event_id"], "event_type")


@query("SELECT domain, node, CASE WHEN (row_number() OVER (PARTITION BY domain ORDER BY node) - 1) % 2 = 0 THEN 'val' ELSE 'test' END AS split FROM point")
def alternate_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.alternate_split(frame(spark, sf_dir, "point"), ["domain"], ["node"]).select("domain", "node", "split")


@query("SELECT node, concat('at.', lower(domain), '.', CASE WHEN n < 10 THEN concat('0', CAST(n AS VARCHAR)) ELSE CAST(n AS VARCHAR) END) AS serial_id FROM (SELECT node, domain, row_number() OVER (PARTITION BY domain ORDER BY node) AS n FROM point)")
def serial_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.serial_ids(frame(spark, sf_dir, "point"), "domain", ["node"], F.concat(F.lit("at."), F.lower("domain"))).select("node", "serial_id")


@query("SELECT node, position FROM point WHERE position > CAST(1500 AS BIGINT) * 1000000000 ORDER BY position, node LIMIT 20")
def unlearned_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.unlearned_next(frame(spark, sf_dir, "point"), 1500 * 10**9, 20).select("node", "position")


# Joins of candidates.
_TIME = """
    SELECT a.node AS a, b.node AS b, 'time_same_thread' AS route FROM point a JOIN point b ON a.domain = b.domain AND a.thread = b.thread AND a.position < b.position
    UNION ALL
    SELECT a.node, b.node, 'time_same_topic' FROM point a JOIN point b ON a.topic = b.topic AND a.position < b.position WHERE NOT (a.domain = b.domain AND a.thread = b.thread)"""


@query(f"SELECT * FROM ({_TIME})")
def theta_self_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of a topic are the result, so it grows with the square of a topic."""
    return candidates.time_pairs(frame(spark, sf_dir, "point"))


_COOC = "SELECT other AS a, prim AS b, count(*) AS \"count\" FROM item_ref GROUP BY other, prim"


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, "item_ref").groupBy("item_id", F.col("prim").alias("primary")).agg(F.array_sort(F.collect_list("other")).alias("others"))


@query(_COOC)
def cooccurrence_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates.cooccurrence(_items(spark, sf_dir))


@query("SELECT a.node AS a, b.node AS b, 'band' AS route FROM point a JOIN point b ON a.domain = b.domain AND a.thread = b.thread AND a.node < b.node AND abs(a.grade - b.grade) <= 1")
def band_self_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates.band_pairs(frame(spark, sf_dir, "point").withColumn("book", F.col("grade")))


@query(f"""
    WITH every AS (SELECT a, b, route, 0 AS n FROM ({_TIME}) UNION ALL SELECT a, b, 'cooccurrence', 1 FROM ({_COOC}) WHERE "count" >= 2 UNION ALL SELECT src, dst, 'extends', 2 FROM edge)
    SELECT a, b, string_agg(route, ',' ORDER BY n, route) AS routes FROM (SELECT DISTINCT a, b, route, n FROM every WHERE a <> b) GROUP BY a, b""")
def route_union_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    together = candidates.cooccurrence(_items(spark, sf_dir)).where("count >= 2").select("a", "b", F.lit("cooccurrence").alias("route"))
    extends = frame(spark, sf_dir, "edge").select(F.col("src").alias("a"), F.col("dst").alias("b"), F.lit("extends").alias("route"))
    return candidates.with_time_pairs(frame(spark, sf_dir, "point"), [together, extends])


_EVIDENCE = f"""
    WITH c AS ({_COOC}), t AS (SELECT prim AS node, count(*) AS n FROM first_line GROUP BY prim),
         nb AS (SELECT * FROM (SELECT node AS a, lead(node) OVER (PARTITION BY thread, domain ORDER BY position, node) AS b FROM point) WHERE b IS NOT NULL),
         ev AS (
    SELECT e.src AS a, e.dst AS b, coalesce(c1."count", 0) AS cooccurrence, round(coalesce(CAST(c1."count" AS DOUBLE) / t.n, 0.0), 4) AS cooccurrence_ratio, coalesce(c2."count", 0) AS reverse_cooccurrence,
           (p.domain = q.domain AND p.thread = q.thread) AS same_thread, nb.a IS NOT NULL AS adjacent, p.position > q.position AS conflict, q.grade - p.grade AS book_gap
    FROM (SELECT src, dst FROM edge) e LEFT JOIN c c1 ON e.src = c1.a AND e.dst = c1.b LEFT JOIN c c2 ON e.src = c2.b AND e.dst = c2.a LEFT JOIN t ON t.node = e.dst
         LEFT JOIN nb ON nb.a = e.src AND nb.b = e.dst JOIN point p ON p.node = e.src JOIN point q ON q.node = e.dst)"""


def _evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = frame(spark, sf_dir, "point").withColumn("book", F.col("grade"))
    pairs = frame(spark, sf_dir, "edge").select(F.col("src").alias("a"), F.col("dst").alias("b"))
    totals = frame(spark, sf_dir, "first_line").groupBy(F.col("prim").alias("node")).agg(F.count(F.lit(1)).alias("n"))
    near = sequence.adjacent_pairs(points, ["thread", "domain"], ["position", "node"], "node")
    return candidates.evidence(pairs, candidates.cooccurrence(_items(spark, sf_dir)), totals, points, near)


@query(_EVIDENCE + " SELECT * FROM ev")
def cooccurrence_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evidence(spark, sf_dir)


@query(_EVIDENCE + """ SELECT a, b, CASE WHEN conflict THEN 'C' WHEN reverse_cooccurrence > cooccurrence THEN 'R' WHEN NOT same_thread AND cooccurrence >= 3 THEN 'X' WHEN same_thread AND adjacent THEN 'T'
    WHEN cooccurrence_ratio >= 0.1 THEN 'M' WHEN cooccurrence > 0 THEN 'P' ELSE 'N' END AS stratum FROM ev""")
def pair_strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evidence(spark, sf_dir).select("a", "b", candidates.pair_stratum().alias("stratum"))


@query("SELECT item_id, prim AS \"primary\", string_agg(CAST(other AS VARCHAR), ',' ORDER BY other) AS others FROM item_ref GROUP BY item_id, prim")
def rewritten_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _items(spark, sf_dir).withColumn("book", F.lit("b"))
    mapping = frame(spark, sf_dir, "part").select(F.lit("b").alias("book_id"), F.col("p_partkey").alias("local_id"), F.col("p_partkey").alias("canonical_id"))
    out = candidates.rewritten_refs(items, mapping, "item_id", "book", "primary", "others")
    return out.select("item_id", "primary", F.array_join(F.col("others").cast("array<string>"), ",").alias("others"))


@query("SELECT a, b FROM (SELECT p.node AS a, q.node AS b FROM point p JOIN point q ON p.lesson_id = q.lesson_id AND p.node < q.node)")
def cannot_link_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = frame(spark, sf_dir, "point").groupBy("lesson_id").agg(F.collect_list("node").alias("members"))
    return candidates.cannot_link(lists, "lesson_id", "members")


@query("SELECT a.node AS a, b.node AS b FROM point a JOIN point b ON a.domain = b.domain AND a.position < b.position WHERE NOT EXISTS (SELECT 1 FROM edge e WHERE e.src = a.node AND e.dst = b.node)")
def non_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All earlier-later pairs of a domain are looked at, so the result grows with the square of a domain."""
    return candidates.non_candidates(frame(spark, sf_dir, "point"), frame(spark, sf_dir, "edge").select(F.col("src").alias("a"), F.col("dst").alias("b")))


@query("SELECT p_partkey AS kp_id, CAST(coalesce(n, 0) AS BIGINT) AS uses, TRUE AS expected FROM part LEFT JOIN (SELECT kp_id, count(*) AS n FROM holds GROUP BY kp_id) u ON u.kp_id = p_partkey WHERE coalesce(n, 0) <> 1")
def exactly_once_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.not_once(frame(spark, sf_dir, "part").select(F.col("p_partkey").alias("kp_id")), frame(spark, sf_dir, "holds"), "kp_id")


@query("SELECT node, 'left' AS side FROM point WHERE grade <= 2 AND node NOT IN (SELECT node FROM point WHERE size > 25) UNION ALL SELECT node, 'right' FROM point WHERE size > 25 AND node NOT IN (SELECT node FROM point WHERE grade <= 2)")
def set_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = frame(spark, sf_dir, "point")
    return curation.symmetric_difference(p.where("grade <= 2"), p.where("size > 25"), "node")


@query("""SELECT coalesce(a.k, b.k) AS file, CASE WHEN a.k IS NULL THEN 'unlisted' WHEN b.k IS NULL THEN 'missing' ELSE 'differs' END AS problem
    FROM (SELECT p_partkey AS k, p_size AS v FROM part WHERE p_partkey % 7 <> 0) a FULL OUTER JOIN (SELECT node AS k, size + CASE WHEN node % 11 = 0 THEN 1 ELSE 0 END AS v FROM point) b ON a.k = b.k
    WHERE a.k IS NULL OR b.k IS NULL OR a.v <> b.v""")
def manifest_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = frame(spark, sf_dir, "part").where("p_partkey % 7 <> 0").select(F.col("p_partkey").alias("file"), F.col("p_size").alias("sha256"))
    actual = frame(spark, sf_dir, "point").select(F.col("node").alias("file"), (F.col("size") + F.when(F.col("node") % 11 == 0, 1).otherwise(0)).alias("sha256"))
    return verify_manifest(listed, actual)


@query("SELECT node FROM point WHERE grade = 1 INTERSECT SELECT kp_id FROM holds WHERE line = 1")
def set_intersections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.common(frame(spark, sf_dir, "point").where("grade = 1"), frame(spark, sf_dir, "holds").where("line = 1").withColumnRenamed("kp_id", "node"), "node")


@query("SELECT src, dst, type FROM edge UNION ALL SELECT dst, src, 'reverse' FROM edge")
def edges_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.both_ways(frame(spark, sf_dir, "edge"))


@query("SELECT h.lesson_id, h.kp_id, CASE WHEN p.lesson_id = h.lesson_id THEN 'intro' ELSE 'practice' END AS part FROM holds h JOIN point p ON p.node = h.kp_id")
def intro_practice_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.intro_and_practice(frame(spark, sf_dir, "holds"), frame(spark, sf_dir, "point"))


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 2)")
def dangling_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = frame(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("node"))
    return graph.dangling(refs, frame(spark, sf_dir, "part").where("p_size > 2").select(F.col("p_partkey").alias("node")), "node").withColumnRenamed("node", "l_partkey")


@query("SELECT book_id, max_by(lesson_id, position) AS last_lesson FROM lesson GROUP BY book_id")
def book_end_lesson(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.last_lessons(frame(spark, sf_dir, "lesson"))
