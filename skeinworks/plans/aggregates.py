"""Aggregations: roll-ups, merges, envelopes, back-off groups, difficulty, coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinworks.functions.scalars import digits_bucket, last_segment, places_bucket, steps_bucket
from skeinworks.operators import grouping, lattice, reports
from skeinworks.plans.catalogue import query
from skeinworks.plans.fixtures import frame
from skeinworks.session import tasks_for

@query("SELECT o_orderpriority, o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderpriority, o_orderstatus")
def counts_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reports.counts(frame(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderstatus"], total=F.col("o_totalprice"))
    return found.withColumn("total", F.round("total", 2))


@query("SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY ROLLUP (o_orderpriority, o_orderstatus)")
def totals_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.counts_with_totals(frame(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderstatus"])


@query("SELECT coalesce(o_orderstatus, '_all') AS kind, count(*) AS n, CAST(count_if(o_totalprice > 100000) AS BIGINT) AS passed FROM orders GROUP BY GROUPING SETS ((o_orderstatus), ())")
def review_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.review_stats(frame(spark, sf_dir, "orders"), "o_orderstatus", F.col("o_totalprice") > 100000)


@query("SELECT o_orderpriority, CAST(count_if(o_orderstatus = 'F') AS BIGINT) AS f, CAST(count_if(o_orderstatus = 'O') AS BIGINT) AS o, CAST(count_if(o_orderstatus = 'P') AS BIGINT) AS p FROM orders GROUP BY o_orderpriority")
def pivot_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.coverage_matrix(frame(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus", {"F": "f", "O": "o", "P": "p"})


@query("""
    WITH c AS (SELECT l_partkey, l_returnflag, count(*) AS c, min(l_orderkey) AS first FROM lineitem GROUP BY l_partkey, l_returnflag),
         r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY c DESC, first) AS k FROM c)
    SELECT l_partkey, CASE WHEN count(*) FILTER (WHERE k > 0) > 0 THEN max(c) END AS n FROM r WHERE k = 1 GROUP BY l_partkey""")
def mode_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouping.mode_of(frame(spark, sf_dir, "lineitem"), "l_partkey", "l_returnflag", "l_orderkey").select("l_partkey", "n")


@query("SELECT l_partkey AS kp_id, l_returnflag AS op, l_linestatus AS token, CAST(max(l_quantity) AS BIGINT) AS num FROM lineitem GROUP BY l_partkey, l_returnflag, l_linestatus")
def grants_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    grants = frame(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("kp_id"), F.lit("flags").alias("dimension"), F.col("l_returnflag").alias("op"), F.col("l_linestatus").alias("token"), F.col("l_quantity").cast("long").alias("num"))
    return lattice.merged_grants(grants, "kp_id").drop("dimension")


@query("""
    SELECT thread AS cluster, arg_min(node, position * 100000 + node % 100000) AS primary_key, arg_min(name, position * 100000 + node % 100000) AS name, min(position) AS intro_position,
           CAST(max(size) AS INTEGER) AS mastery_rank, bool_or(price > 1000) AS assessable, count(*) AS n_members, CAST(count(DISTINCT position) - 1 AS INTEGER) AS reviews
    FROM point GROUP BY thread""")
def canonical_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = frame(spark, sf_dir, "point")
    members = p.select(F.col("thread").alias("cluster"), F.col("node").alias("key"), "position", "name", F.array("topic").alias("aliases"), F.col("size").alias("mastery_rank"), (F.col("price") > 1000).alias("assessable"))
    out = grouping.canonical_merge(members)
    return out.select("cluster", "primary_key", "name", "intro_position", "mastery_rank", "assessable", "n_members", F.size("review_positions").alias("reviews"))


@query("SELECT CASE WHEN row_number() OVER (PARTITION BY name ORDER BY position, node) > 1 THEN concat(name, '_', domain) ELSE name END AS name, node FROM point")
def distinct_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouping.distinct_names(frame(spark, sf_dir, "point"), "name", "domain", ["position", "node"]).select("name", "node")


_JUDGED = "SELECT l_partkey AS narrow, l_suppkey AS wide, round(l_discount * 10, 2) AS confidence, l_orderkey * 10 + l_linenumber AS judgment_id FROM lineitem WHERE l_partkey < 40 * l_suppkey"


@query(f"""
    WITH j AS (SELECT * FROM ({_JUDGED}) WHERE narrow <> wide)
    SELECT narrow, wide, string_agg(CAST(judgment_id AS VARCHAR), ',' ORDER BY judgment_id) AS evidence, max(confidence) AS confidence,
           (list(judgment_id ORDER BY confidence DESC, judgment_id))[1] AS judgment_id FROM j GROUP BY narrow, wide""")
def best_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame(spark, sf_dir, "lineitem")
    return grouping.best_evidence(spark.sql(_JUDGED))


@query("""
    SELECT p_brand, l_returnflag, count(*) AS n, min(l_quantity) AS min_l_quantity, max(l_quantity) AS max_l_quantity, min(l_linenumber) AS min_l_linenumber, max(l_linenumber) AS max_l_linenumber,
           string_agg(DISTINCT l_linestatus, ',' ORDER BY l_linestatus) AS l_linestatus_set, round(avg(CAST(l_tax > 0.04 AS INT)), 3) AS taxed_ratio
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand, l_returnflag""")
def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frame(spark, sf_dir, "lineitem").join(frame(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).withColumn("taxed", F.col("l_tax") > 0.04)
    return grouping.envelope(rows, ["p_brand", "l_returnflag"], ["l_quantity", "l_linenumber"], ["l_linestatus"], "taxed")


@query("SELECT p_brand, string_agg(concat(f, ':', CAST(c AS VARCHAR)), ',' ORDER BY f) AS histogram FROM (SELECT p_brand, l_returnflag AS f, count(*) AS c FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand, l_returnflag) GROUP BY p_brand")
def answer_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frame(spark, sf_dir, "lineitem").join(frame(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return grouping.histogram(rows, ["p_brand"], "l_returnflag")


@query(r"""SELECT lang, source, count(*) AS n, min(CAST(x AS DECIMAL(30, 6))) AS low, max(CAST(x AS DECIMAL(30, 6))) AS high FROM (SELECT lang, source, unnest(regexp_extract_all(text, '([0-9]{1,9}(?:\.[0-9]{1,6})?)', 1)) AS x FROM documents) GROUP BY lang, source""")
def context_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.number_envelope(frame(spark, sf_dir, "documents"), ["lang", "source"], "text")


@query("SELECT regexp_replace(p_name, '\\s+', '', 'g') AS term, string_agg(alias, ',' ORDER BY k) AS aliases, count(*) AS n_aliases FROM (SELECT p_name, p_type AS alias, min(p_partkey) AS k FROM part GROUP BY p_name, p_type) GROUP BY p_name")
def glossary_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frame(spark, sf_dir, "part").select(F.col("p_name").alias("term"), F.col("p_type").alias("alias"), F.lit(None).cast("string").alias("notation"), F.col("p_brand").alias("book"), F.col("p_partkey").alias("k"))
    out = grouping.glossary_merge(rows, ["k"])
    return out.select("term", "aliases", F.size(F.split("aliases", ",")).cast("long").alias("n_aliases"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN q <= 1 THEN '1' WHEN q <= 4 THEN CAST(q AS VARCHAR) WHEN q <= 8 THEN '5-8' ELSE '9+' END AS digits, CASE WHEN l_linenumber <= 0 THEN '0' WHEN l_linenumber <= 2 THEN CAST(l_linenumber AS VARCHAR) ELSE '3+' END AS places, CASE WHEN l_linenumber <= 1 THEN '1' WHEN l_linenumber = 2 THEN '2' ELSE '3+' END AS steps FROM (SELECT *, CAST(l_quantity AS INT) AS q FROM lineitem)")
def operand_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("l_quantity").cast("int")
    return frame(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", digits_bucket(q).alias("digits"), places_bucket(F.col("l_linenumber")).alias("places"), steps_bucket(F.col("l_linenumber")).alias("steps"))


_BACKOFF = """
    WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus FROM lineitem),
         a AS (SELECT *, count(*) OVER (PARTITION BY l_partkey, l_returnflag, l_linestatus, l_linenumber) AS n2 FROM r),
         b AS (SELECT *, count(*) FILTER (WHERE n2 < 2) OVER (PARTITION BY l_partkey, l_returnflag) AS n1 FROM a),
         g AS (SELECT *, CASE WHEN n2 >= 2 THEN 2 WHEN n1 >= 2 THEN 1 ELSE 0 END AS level FROM b)"""


def _backoff(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """The lines with their groups, and the number of tasks that they are dealt among."""
    lines = frame(spark, sf_dir, "lineitem")
    tasks = tasks_for(lines)
    return grouping.backoff_groups(lines, ["l_partkey"], [["l_returnflag", "l_linestatus", "l_linenumber"], ["l_returnflag"], []], tasks=tasks), tasks


@query(_BACKOFF + " SELECT l_partkey, level, count(*) AS n FROM g GROUP BY l_partkey, level")
def backoff_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines are counted where they were dealt, by flag; only these counts are dealt by part."""
    rows, tasks = _backoff(spark, sf_dir)
    by_flag = rows.groupBy("l_partkey", "l_returnflag", "level").agg(F.count(F.lit(1)).alias("n"))
    return by_flag.repartition(tasks, "l_partkey").groupBy("l_partkey", "level").agg(F.sum("n").alias("n"))


@query()
def singleton_attachment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A part has one group of lines left at the last level, so one singleton at most is walked for it: bounded."""
    rows, tasks = _backoff(spark, sf_dir)
    rows = rows.select("l_partkey", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice").alias("item_id"), "group_key", F.col("l_returnflag").alias("d1"), F.col("l_linestatus").alias("d2"), F.col("l_linenumber").cast("string").alias("d3"))
    return grouping.attached_singletons(rows, ["l_partkey"], ["d1", "d2", "d3"], "item_id", "group_key", tasks)


@query("""
    WITH s AS (SELECT l_partkey, l_returnflag, l_linestatus, count(*) AS c FROM lineitem GROUP BY ALL), k AS (SELECT l_partkey, sum(c) AS t, count(*) AS k, count_if(c = 1) AS s FROM s GROUP BY l_partkey),
         a AS (SELECT CAST(sum(k) AS BIGINT) AS n, CAST(sum(s) AS BIGINT) AS singletons, count_if(t = 1) AS lone, sum(t) AS items FROM k)
    SELECT n, singletons, round(singletons / n, 4) AS ratio, round(lone / n, 4) AS floor, round(singletons / n - lone / n, 4) AS excess, round(items / n, 3) AS compression FROM a""")
def singleton_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frame(spark, sf_dir, "lineitem").withColumn("g", F.concat_ws("|", "l_partkey", "l_returnflag", "l_linestatus"))
    return grouping.singleton_stats(rows, "g", "l_partkey")


_DIFFICULTY = """
    WITH m AS (SELECT avg(size) AS a, stddev_pop(size) AS b, avg(price) AS c, stddev_pop(price) AS d FROM point),
         z AS (SELECT node, grade, round((size - a) / b + (price - c) / d, 4) AS score FROM point, m),
         r AS (SELECT *, rank() OVER (PARTITION BY grade ORDER BY score) - 1 AS k, count(*) OVER (PARTITION BY grade) AS n FROM z)"""


@query(_DIFFICULTY + " SELECT node, grade, CAST(least(5, 1 + floor(5.0 * k / n)) AS INTEGER) AS difficulty FROM r")
def difficulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouping.difficulty(frame(spark, sf_dir, "point"), ["size", "price"], "grade").select("node", "grade", "difficulty")


@query(_DIFFICULTY + " SELECT node, CAST(1 + size % 5 AS INTEGER) AS old, CAST(least(5, 1 + floor(5.0 * k / n)) AS INTEGER) AS \"new\" FROM r JOIN point USING (node) WHERE 1 + size % 5 <> least(5, 1 + floor(5.0 * k / n))")
def stale_difficulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = frame(spark, sf_dir, "point")
    new = grouping.difficulty(p, ["size", "price"], "grade")
    return grouping.stale(p.select("node", (1 + F.col("size") % 5).alias("difficulty")), new, "node", "difficulty")


@query("SELECT node, CASE WHEN count(*) OVER (PARTITION BY last_part) > 1 THEN concat(thread, '_', last_part) ELSE last_part END AS slug FROM (SELECT node, thread, list_extract(string_split(name, ' '), -1) AS last_part FROM point)")
def kp_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.slugs(frame(spark, sf_dir, "point"), "node", "thread", last_segment(F.col("name"), " "))


@query("SELECT count(DISTINCT l_partkey) AS covered, count(DISTINCT l_orderkey) AS items, round(count(*) / CAST(count(DISTINCT l_partkey) AS DOUBLE), 4) AS compression FROM lineitem")
def coverage_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.coverage_ratios(frame(spark, sf_dir, "lineitem"), "l_partkey", "l_orderkey")


@query("SELECT l_orderkey, CASE WHEN count_if(l_linestatus = 'F') = count(*) THEN 'covered' WHEN count_if(l_linestatus = 'F') = 0 THEN 'not_covered' ELSE 'partial' END AS verdict FROM lineitem GROUP BY l_orderkey")
def item_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.item_verdicts(frame(spark, sf_dir, "lineitem"), "l_orderkey", F.col("l_linestatus") == "F")


@query("SELECT l_partkey, count(*) AS cards, floor(avg(l_linenumber) * 100 + 0.5) / 100 AS mean_level, CAST(count_if(l_returnflag = 'A') AS BIGINT) AS a, CAST(count_if(l_returnflag = 'N') AS BIGINT) AS n, CAST(count_if(l_returnflag = 'R') AS BIGINT) AS r FROM lineitem GROUP BY l_partkey")
def point_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.point_rollup(frame(spark, sf_dir, "lineitem"), "l_partkey", "l_linenumber", "l_returnflag", {"A": "a", "N": "n", "R": "r"})


@query("SELECT l_returnflag, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_returnflag, l_linenumber")
def two_way_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.counts(frame(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linenumber"])


@query("SELECT unit_id, count(*) AS n_new, array_to_string(list_slice(list(CAST(node AS VARCHAR) ORDER BY node), 1, 6), ',') AS first_six FROM point GROUP BY unit_id")
def timeline_additions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.additions_by_unit(frame(spark, sf_dir, "point"), "unit_id", "node")


@query("SELECT event_type, array_to_string(list_slice(list(CAST(user_id AS VARCHAR) ORDER BY c DESC, user_id), 1, 5), ',') AS members FROM (SELECT event_type, user_id, count(*) AS c FROM events GROUP BY event_type, user_id) GROUP BY event_type")
def context_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.most_frequent(frame(spark, sf_dir, "events"), "event_type", "user_id")


@query("SELECT coalesce(a.user_id, b.c_custkey) AS id, coalesce(a.n, 0) AS n FROM (SELECT user_id, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY user_id) a FULL OUTER JOIN customer b ON a.user_id = b.c_custkey")
def observations_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.observations(frame(spark, sf_dir, "events").where("event_type <> 'error'"), "user_id", frame(spark, sf_dir, "customer"), "c_custkey")


@query("""
    SELECT p_partkey AS item_id, CASE WHEN p_size <= 10 OR (p_size > 40) THEN 'covered' WHEN p_size <= 20 THEN 'not_applicable' WHEN p_size <= 25 THEN 'covered' WHEN p_size <= 30 THEN 'not_applicable' ELSE 'uncovered' END AS status,
           CASE WHEN p_size <= 10 AND p_size > 5 THEN 'a,p' WHEN p_size <= 5 THEN 'p' WHEN p_size > 40 THEN 'a' WHEN p_size > 20 AND p_size <= 25 THEN 'm' ELSE '' END AS kp_ids FROM part""")
def final_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = frame(spark, sf_dir, "part").select(F.col("p_partkey").alias("item_id"), "p_size")
    ids = lambda cond, x: part.where(cond).select("item_id", F.array(F.lit(x)).alias("kp_ids"))
    return grouping.final_mapping(part, ids("p_size <= 10", "p"), ids("(p_size > 5 AND p_size <= 10) OR p_size > 40", "a"), part.where("p_size > 10 AND p_size <= 20"), ids("p_size > 20 AND p_size <= 25", "m"), part.where("p_size > 25 AND p_size <= 30"))
