"""Graph queries over the prerequisite edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinworks.operators import candidates, clusters, graph, reachability
from skeinworks.operators.components import connected_components
from skeinworks.plans.catalogue import query
from skeinworks.plans.fixtures import frame, views
from skeinworks.session import materialise

_CLOSURE = "WITH RECURSIVE e AS (SELECT DISTINCT src, dst FROM edge), reach(src, dst) AS (SELECT src, dst FROM e UNION SELECT r.src, e.dst FROM reach r JOIN e ON r.dst = e.src)"
_DEPTH = "WITH RECURSIVE e AS (SELECT DISTINCT src, dst FROM edge), walk(start, node, depth) AS (SELECT DISTINCT src, src, 0 FROM e UNION SELECT w.start, e.dst, w.depth + 1 FROM walk w JOIN e ON w.node = e.src)"


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written once: every round and every part of a query reads them."""
    return materialise(frame(spark, sf_dir, "edge"), "edge", few=True)


@query(_CLOSURE + " SELECT src, dst FROM reach")
def dag_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.closure(_edges(spark, sf_dir))


def _starts(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("src").alias("start")).distinct()


@query(_DEPTH + " SELECT start, node, CAST(min(depth) AS INTEGER) AS depth FROM walk WHERE start <> node GROUP BY start, node")
def chain_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _edges(spark, sf_dir)
    return graph.reach(e, _starts(e), via=False)


@query()
def chain_via(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _edges(spark, sf_dir)
    return graph.reach(e, _starts(e))


@query(_DEPTH + " SELECT start, node, CAST(min(depth) AS INTEGER) AS depth FROM walk WHERE start <> node AND depth <= 2 GROUP BY start, node")
def chain_two_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _edges(spark, sf_dir)
    return graph.reach(e, _starts(e), depth=2, via=False)


@query("""WITH RECURSIVE e AS (SELECT DISTINCT dst AS src, src AS dst FROM edge), walk(start, node, depth) AS (SELECT DISTINCT src, src, 0 FROM e UNION SELECT w.start, e.dst, w.depth + 1 FROM walk w JOIN e ON w.node = e.src)
    SELECT start, node, CAST(min(depth) AS INTEGER) AS depth FROM walk WHERE start <> node GROUP BY start, node""")
def prerequisites_of_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _edges(spark, sf_dir)
    return graph.reach(e, e.select(F.col("dst").alias("start")).distinct(), backwards=True, via=False)


_DIRECT = _CLOSURE + ", red AS (SELECT DISTINCT e.src, e.dst FROM e JOIN e m ON m.src = e.src JOIN reach r ON r.src = m.dst AND r.dst = e.dst)"


@query(_DIRECT + " SELECT e.src, e.dst, red.src IS NULL AS is_direct FROM e LEFT JOIN red ON e.src = red.src AND e.dst = red.dst")
def transitive_reduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.transitive_reduction(_edges(spark, sf_dir)).select("src", "dst", "is_direct")


@query(_DIRECT + """ SELECT a.src, b.dst, CAST(a.dst AS VARCHAR) AS implied_via FROM red JOIN e a ON a.src = red.src JOIN e b ON a.dst = b.src AND b.dst = red.dst
    WHERE NOT EXISTS (SELECT 1 FROM red x WHERE x.src = a.src AND x.dst = a.dst) AND NOT EXISTS (SELECT 1 FROM red x WHERE x.src = b.src AND x.dst = b.dst)""")
def implied_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.witnesses(_edges(spark, sf_dir))


@query(_DIRECT + """ , kept AS (SELECT e.* FROM e WHERE NOT EXISTS (SELECT 1 FROM red WHERE red.src = e.src AND red.dst = e.dst)), again(src, dst) AS (SELECT src, dst FROM kept UNION SELECT a.src, k.dst FROM again a JOIN kept k ON a.dst = k.src)
    SELECT (SELECT count(*) FROM reach) AS before, (SELECT count(*) FROM again) AS after""")
def reduction_keeps_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _edges(spark, sf_dir)
    kept = graph.transitive_reduction(e).where("is_direct")
    return graph.closure(e).agg(F.count(F.lit(1)).alias("before")).crossJoin(graph.closure(kept).agg(F.count(F.lit(1)).alias("after")))


#: The edges, and some turned round over one neighbour, which makes cycles.
_TURNED = "SELECT src, dst FROM edge UNION SELECT b.dst, a.src FROM edge a JOIN edge b ON a.dst = b.src WHERE a.src % 50 = 0"


_TURNED_REACH = f"WITH RECURSIVE e AS ({_TURNED}), reach(src, dst) AS (SELECT src, dst FROM e UNION SELECT r.src, e.dst FROM reach r JOIN e ON r.dst = e.src)"


def _turned(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _edges(spark, sf_dir).select("src", "dst")
    through = e.where("src % 50 = 0").select(F.col("src").alias("dst"), F.col("dst").alias("m")).join(e.select(F.col("src").alias("m"), F.col("dst").alias("src")), "m").select("src", "dst")
    return e.union(through).distinct()


@query(_TURNED_REACH + " SELECT src AS node FROM reach WHERE src = dst")
def cycle_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.nodes_on_cycles(_turned(spark, sf_dir))


@query(_TURNED_REACH + " SELECT a.src AS node, max(a.dst) AS component FROM reach a JOIN reach b ON b.src = a.dst AND b.dst = a.src GROUP BY a.src")
def strong_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reachability.strong_components(_turned(spark, sf_dir))


@query(_TURNED_REACH + " SELECT src, dst FROM e WHERE EXISTS (SELECT 1 FROM e m JOIN reach r ON r.src = m.dst WHERE m.src = e.src AND r.dst = e.dst)")
def redundant_with_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reachability.redundant_edges(_turned(spark, sf_dir))


# Positions shifted by size, so that some edges run against the order.
_SHIFTED = "SELECT node, CAST(position / 1000000000 + 40 * (size % 5) AS BIGINT) AS position FROM point"
_SHIFTED_DUCK = "SELECT node, position // 1000000000 + 40 * (size % 5) AS position FROM point"


def _shifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame(spark, sf_dir, "point")
    return spark.sql("SELECT node, position div 1000000000 + 40 * (size % 5) AS position FROM point")


@query(f"WITH p AS ({_SHIFTED_DUCK}) SELECT e.src, e.dst, a.position AS src_position, b.position AS dst_position FROM edge e JOIN p a ON a.node = e.src JOIN p b ON b.node = e.dst WHERE a.position > b.position")
def order_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _edges(spark, sf_dir)
    return graph.order_conflicts(e, _shifted(spark, sf_dir))


@query(_CLOSURE + f", p AS ({_SHIFTED_DUCK}), m AS (SELECT r.src AS node, min(p.position) AS low FROM reach r JOIN p ON p.node = r.dst GROUP BY r.src) SELECT p.node, p.position, least(p.position, coalesce(m.low, p.position)) AS moved_to FROM p LEFT JOIN m ON m.node = p.node")
def move_fixpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _edges(spark, sf_dir)
    return graph.moved_to_fixpoint(e, _shifted(spark, sf_dir))


@query("WITH RECURSIVE b AS (SELECT src AS x, dst AS y FROM edge UNION SELECT dst, src FROM edge), c(x, y) AS (SELECT x, y FROM b UNION SELECT c.x, b.y FROM c JOIN b ON c.y = b.x) SELECT x AS node, min(least(x, y)) AS component FROM c GROUP BY x")
def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return connected_components(_edges(spark, sf_dir).select(F.col("src").alias("a"), F.col("dst").alias("b")))


@query("""WITH RECURSIVE b AS (SELECT src AS x, dst AS y FROM edge UNION SELECT dst, src FROM edge), c(x, y) AS (SELECT x, y FROM b UNION SELECT c.x, b.y FROM c JOIN b ON c.y = b.x),
    l AS (SELECT x, min(least(x, y)) AS k FROM c GROUP BY x) SELECT count(DISTINCT k) AS components, count(*) AS nodes FROM l""")
def weak_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = connected_components(_edges(spark, sf_dir).select(F.col("src").alias("a"), F.col("dst").alias("b")))
    return found.agg(F.countDistinct("component").alias("components"), F.count(F.lit(1)).alias("nodes"))


@query(_DEPTH + " SELECT node, CAST(max(depth) AS INTEGER) AS depth FROM walk GROUP BY node UNION SELECT dst, 0 FROM e WHERE FALSE")
def path_depths(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _edges(spark, sf_dir)
    inner = e.select(F.col("src").alias("node")).union(e.select("dst")).distinct()
    return graph.levels(e).join(inner, "node")


@query(_DEPTH + """, d AS (SELECT node, max(depth) AS depth FROM walk GROUP BY node),
    b AS (SELECT e.dst AS node, min(e.src) AS back FROM e JOIN d x ON x.node = e.src JOIN d y ON y.node = e.dst WHERE x.depth + 1 = y.depth GROUP BY e.dst),
    path(node, place) AS (SELECT min(node), depth FROM d WHERE depth = (SELECT max(depth) FROM d) GROUP BY depth UNION SELECT b.back, p.place - 1 FROM path p JOIN b ON b.node = p.node)
    SELECT CAST(place AS INTEGER) AS place, node FROM path""")
def longest_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.longest_path(_edges(spark, sf_dir))


@query("SELECT p.node, CAST(coalesce(i.n, 0) AS BIGINT) AS indegree, CAST(coalesce(o.n, 0) AS BIGINT) AS outdegree FROM point p LEFT JOIN (SELECT dst, count(*) AS n FROM edge GROUP BY dst) i ON i.dst = p.node LEFT JOIN (SELECT src, count(*) AS n FROM edge GROUP BY src) o ON o.src = p.node")
def degree_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _edges(spark, sf_dir)
    return graph.degrees(e, frame(spark, sf_dir, "point"))


@query("""WITH RECURSIVE e AS (SELECT DISTINCT dst AS src, src AS dst FROM edge), walk(start, node, depth) AS (SELECT DISTINCT src, src, 0 FROM e UNION SELECT w.start, e.dst, w.depth + 1 FROM walk w JOIN e ON w.node = e.src),
    d AS (SELECT w.node, CAST(min(w.depth) AS INTEGER) AS depth FROM walk w WHERE w.start <> w.node GROUP BY w.node)
    SELECT d.node, d.depth, p.position FROM d JOIN point p ON p.node = d.node WHERE p.position < CAST(900 AS BIGINT) * 1000000000""")
def review_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = materialise(frame(spark, sf_dir, "point").select("node", "position"), "point", few=True)
    near = graph.nearest_start(_edges(spark, sf_dir), p.select(F.col("node").alias("start")), backwards=True)
    return near.join(p.select("node", "position"), "node").where("position < CAST(900 AS BIGINT) * 1000000000")


@query("SELECT src AS node, type, dst AS other, 'out' AS direction FROM edge UNION ALL SELECT dst, type, src, 'in' FROM edge")
def relations_both_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.relations(_edges(spark, sf_dir))


@query("SELECT src, dst, type FROM edge WHERE src % 3 <> 0 UNION ALL SELECT DISTINCT dst, src, 'prerequisite' FROM edge WHERE src % 3 = 0")
def gap_edges_inserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _edges(spark, sf_dir).select("src", "dst", "type")
    new = e.where("src % 3 = 0").select(F.col("dst").alias("src"), F.col("src").alias("dst"), "type").union(e.where("src % 3 = 1"))
    return graph.inserted(e.where("src % 3 <> 0"), new)


@query("WITH two AS (SELECT src, dst FROM edge UNION ALL SELECT dst, src FROM edge WHERE src % 2 = 0) SELECT b.src, b.dst FROM two b JOIN point p ON p.node = b.src JOIN point q ON q.node = b.dst WHERE NOT EXISTS (SELECT 1 FROM two r WHERE r.src = b.dst AND r.dst = b.src) OR p.grade < q.grade")
def mutual_edges_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _edges(spark, sf_dir).select("src", "dst")
    both = e.union(e.where("src % 2 = 0").select("dst", "src"))
    return graph.without_mutual(both, frame(spark, sf_dir, "point").select("node", F.col("grade").alias("stage")))


@query("""SELECT node, CASE WHEN first_dependant IS NULL THEN greatest(stage_end, coalesce(latest, stage_end)) WHEN stage_end < soft AND stage_end >= low THEN stage_end ELSE soft END AS place FROM
    (SELECT *, CASE WHEN early < first_dependant AND early >= low THEN early ELSE first_dependant END AS soft FROM
     (SELECT node, CASE WHEN size % 4 = 0 THEN NULL ELSE size * 3 END AS first_dependant, 60 AS stage_end, size AS low, CASE WHEN size % 3 = 0 THEN size * 2 END AS early, CASE WHEN size % 5 = 0 THEN size + 50 END AS latest FROM point))""")
def gap_placement_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("size")
    gaps = frame(spark, sf_dir, "point").select("node", F.when(s % 4 != 0, s * 3).alias("first_dependant"), F.lit(60).alias("stage_end"), s.alias("floor"), F.when(s % 3 == 0, s * 2).alias("soft_earlier"), F.when(s % 5 == 0, s + 50).alias("latest_prerequisite"))
    return graph.placed_gaps(gaps).select("node", "place")


@query("SELECT src, dst, CASE WHEN src % 10 = 0 THEN 'related' WHEN conf < 0.95 THEN 'builds_on' ELSE 'prerequisite' END AS type FROM (SELECT *, (src % 21) / 20.0 AS conf FROM edge)")
def edge_post_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _edges(spark, sf_dir)
    return e.select("src", "dst", candidates.edge_kind(F.col("type"), (F.col("src") % 21) / 20.0, F.col("src") % 10 == 0).alias("type"))


@query("SELECT concat(CASE WHEN src % 4 = 0 THEN 'e.related.' ELSE 'e.prerequisite.' END, CAST(src AS VARCHAR), '.', CAST(dst AS VARCHAR)) AS id, CASE WHEN src % 4 = 0 THEN 'related' ELSE type END AS type, src, dst, CASE WHEN src % 4 = 0 THEN 'reconciled' ELSE 'textbook' END AS provenance, CASE WHEN src % 4 = 0 THEN 'triage' END AS note FROM edge")
def dropped_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _edges(spark, sf_dir).select(F.concat_ws(".", F.lit("e.prerequisite"), "src", "dst").alias("id"), "type", "src", "dst", F.lit("textbook").alias("provenance"))
    return candidates.dropped(e, e.where("src % 4 = 0").select("src", "dst", "type", F.lit("triage").alias("reason")))


@query()
def constrained_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prerequisites as links, points of one lesson as forbidden pairs."""
    e = _edges(spark, sf_dir)
    links = e.select(F.col("src").alias("a"), F.col("dst").alias("b"), ((F.col("src") * 7 + F.col("dst")) % 100 / 100.0).alias("confidence"))
    return clusters.constrained_clusters(links, frame(spark, sf_dir, "point").select("node", "thread", "domain", "size"))


#: Four edges that break rules: a missing end, a loop, one twice, one turned round.
_UNSOUND = """WITH bad AS (SELECT src, dst FROM edge UNION ALL SELECT min(src), -1 FROM edge UNION ALL SELECT min(dst), min(dst) FROM edge UNION ALL SELECT src, dst FROM edge WHERE src = (SELECT min(src) FROM edge)
    UNION ALL SELECT dst, src FROM edge WHERE dst = (SELECT max(dst) FROM edge))"""


@query(_UNSOUND + """, d AS (SELECT DISTINCT src, dst FROM bad), v AS (
    SELECT 'missing end' AS rule, src, dst FROM d WHERE src NOT IN (SELECT node FROM point) OR dst NOT IN (SELECT node FROM point)
    UNION ALL SELECT 'self loop', src, dst FROM d WHERE src = dst
    UNION ALL SELECT 'repeated', src, dst FROM bad GROUP BY src, dst HAVING count(*) > 1
    UNION ALL SELECT 'mutual', a.src, a.dst FROM d a JOIN d b ON a.src = b.dst AND a.dst = b.src WHERE a.src < a.dst
    UNION ALL SELECT 'against order', e.src, e.dst FROM d e JOIN point a ON a.node = e.src JOIN point b ON b.node = e.dst WHERE a.position > b.position)
    SELECT rule, src, dst FROM v""")
def graph_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _edges(spark, sf_dir).select("src", "dst")
    ends = e.agg(F.min("src").alias("low"), F.min("dst").alias("loop"), F.max("dst").alias("high"))
    one = e.join(ends, F.col("src") == F.col("low")).select("src", "dst").union(e.join(ends, F.col("dst") == F.col("high")).select("dst", "src"))
    bad = e.union(ends.selectExpr("low", "-1")).union(ends.select("loop", "loop")).union(one).withColumn("is_direct", F.lit(None).cast("boolean"))
    return graph.violations(bad, frame(spark, sf_dir, "point").select("node", "position")).where("rule NOT IN ('cycle', 'wrong mark')")


#: Points whose size tells their origin, some named at a lesson that does not hold them, some without a note.
_PLACED = """SELECT node, CASE WHEN node % 29 = 0 THEN -1 ELSE lesson_id END AS lesson_id, CASE WHEN size % 3 = 0 THEN 'reconciled' ELSE 'textbook' END AS origin,
    size % 2 = 0 AS moved, CASE WHEN size % 5 > 0 THEN 'moved' END AS note FROM point"""
_LISTED = "SELECT h.lesson_id, CASE WHEN h.kp_id % 31 = 0 THEN -h.kp_id ELSE h.kp_id END AS node, CASE WHEN h.line % 2 = 1 THEN 'intro' ELSE 'practice' END AS part FROM holds h UNION ALL SELECT lesson_id, kp_id, 'practice' FROM holds WHERE kp_id % 37 = 0"
_REVIEWED = "SELECT c_custkey % 200 + 1 AS node, o_orderkey AS lesson_id FROM orders JOIN customer ON c_custkey = o_custkey"


@query(f"""WITH p AS ({_PLACED}), x AS (SELECT DISTINCT * FROM ({_LISTED}) l), r AS ({_REVIEWED}), s AS (SELECT p.*, l.position FROM p LEFT JOIN lesson l ON l.lesson_id = p.lesson_id), v AS (
    SELECT 'unknown point' AS rule, node, lesson_id FROM x WHERE node NOT IN (SELECT node FROM p)
    UNION ALL SELECT 'no position', node, lesson_id FROM s WHERE position IS NULL
    UNION ALL SELECT 'introduced elsewhere', x.node, x.lesson_id FROM x JOIN p ON p.node = x.node WHERE x.part = 'intro' AND x.lesson_id <> p.lesson_id
    UNION ALL SELECT 'introduced and practised', x.node, x.lesson_id FROM x JOIN x y ON y.node = x.node AND y.lesson_id = x.lesson_id WHERE x.part = 'intro' AND y.part = 'practice'
    UNION ALL SELECT 'not listed', node, lesson_id FROM p WHERE origin = 'reconciled' AND NOT EXISTS (SELECT 1 FROM x WHERE x.node = p.node AND x.lesson_id = p.lesson_id AND x.part = 'intro')
    UNION ALL SELECT 'review too early', r.node, r.lesson_id FROM r JOIN lesson l ON l.lesson_id = r.lesson_id JOIN s ON s.node = r.node WHERE l.position < s.position
    UNION ALL SELECT 'move not minimal', node, lesson_id FROM s WHERE origin = 'reconciled' AND moved AND NOT EXISTS (SELECT 1 FROM edge e JOIN s t ON t.node = e.dst WHERE e.src = s.node AND t.position = s.position)
    UNION ALL SELECT 'no note', node, lesson_id FROM p WHERE origin = 'reconciled' AND note IS NULL)
    SELECT DISTINCT rule, node, lesson_id FROM v""")
def placement_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir, f"{_PLACED} {_LISTED} {_REVIEWED} lesson edge")
    points, listed = materialise(spark.sql(_PLACED), "placed", few=True), materialise(spark.sql(_LISTED), "listed")
    return graph.placement_violations(points, spark.table("lesson"), listed, spark.sql(_REVIEWED), _edges(spark, sf_dir))


_STANDARD = "SELECT o_orderkey AS item_id, CASE o_orderstatus WHEN 'F' THEN 'covered' WHEN 'O' THEN 'uncovered' ELSE 'not_applicable' END AS status, CASE WHEN o_custkey % 2 = 0 THEN 'later' END AS reason FROM orders"


@query(f"""WITH i AS ({_STANDARD}), h AS (SELECT l_orderkey AS item_id, l_partkey AS node FROM lineitem WHERE l_linenumber <= 2), k AS (SELECT p_partkey AS node FROM part WHERE p_size > 5)
    SELECT 'uncovered' AS rule, item_id FROM i WHERE status = 'uncovered'
    UNION ALL SELECT 'bad reference', item_id FROM i WHERE status = 'covered' AND (item_id NOT IN (SELECT item_id FROM h) OR EXISTS (SELECT 1 FROM h WHERE h.item_id = i.item_id AND h.node NOT IN (SELECT node FROM k)))
    UNION ALL SELECT 'no reason', item_id FROM i WHERE status = 'not_applicable' AND reason IS NULL""")
def coverage_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir, f"{_STANDARD} lineitem part")
    nodes = spark.table("lineitem").where("l_linenumber <= 2").groupBy(F.col("l_orderkey").alias("item_id")).agg(F.collect_list("l_partkey").alias("nodes"))
    known = spark.table("part").where("p_size > 5").select(F.col("p_partkey").alias("node"))
    return graph.coverage_violations(spark.sql(_STANDARD).join(nodes, "item_id", "left"), known)
