"""Capability-boundary queries: folds, deltas, first reaching, item checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinworks.functions import numbers
from skeinworks.operators import lattice, reports, sequence
from skeinworks.plans.catalogue import query
from skeinworks.plans.fixtures import frame


@query("SELECT position, max(num) OVER (ORDER BY position ROWS UNBOUNDED PRECEDING) AS bound FROM fact WHERE dimension = 'quantity'")
def grants_fold_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.bound_along(frame(spark, sf_dir, "fact"), "quantity").select("position", "bound")


_INTRO = "SELECT dimension, op, token, min(position) AS position FROM fact WHERE token IS NOT NULL GROUP BY dimension, op, token"


@query(_INTRO)
def introduced_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.introduced(frame(spark, sf_dir, "fact"))


_DELTA = f"SELECT position, dimension, op, string_agg(token, ',' ORDER BY token) AS added FROM ({_INTRO}) GROUP BY position, dimension, op"


@query(_DELTA)
def delta_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.additions(frame(spark, sf_dir, "fact"))


@query(f"SELECT d.position, d.dimension, d.op, string_agg(i.token, ',' ORDER BY i.token) AS allowed FROM ({_DELTA}) d JOIN ({_INTRO}) i ON i.dimension = d.dimension AND i.op = d.op AND i.position <= d.position GROUP BY d.position, d.dimension, d.op")
def delta_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.rebuilt(lattice.additions(frame(spark, sf_dir, "fact")))


@query(f"SELECT l.position, i.dimension, i.op, i.token FROM (SELECT max(position) AS position FROM lesson GROUP BY unit_id) l JOIN ({_INTRO}) i ON i.position <= l.position")
def boundary_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = frame(spark, sf_dir, "lesson").groupBy("unit_id").agg(F.max("position").alias("position"))
    return lattice.boundary_at(frame(spark, sf_dir, "fact"), ends)


@query("SELECT n.dimension, n.need, min(f.position) AS position FROM (SELECT 'quantity' AS dimension, CAST(p_size AS BIGINT) + 5 AS need FROM part GROUP BY p_size) n LEFT JOIN fact f ON f.dimension = n.dimension AND f.num >= n.need GROUP BY n.dimension, n.need")
def first_reaching(spark: SparkSession, sf_dir: str) -> DataFrame:
    needs = frame(spark, sf_dir, "part").select(F.lit("quantity").alias("dimension"), (F.col("p_size").cast("long") + 5).alias("need"))
    return lattice.first_reaching(needs, frame(spark, sf_dir, "fact"))


# Items are order lines, held against the lesson before their order's (those of the first lesson against that one): quantities against the bound, flags against tokens.
_CHECK = f"""
    WITH o AS (SELECT lesson_id AS own, coalesce(lag(lesson_id) OVER w, lesson_id) AS lesson_id, coalesce(lag(position) OVER w, position) AS here, coalesce(lag(unit_id) OVER w, unit_id) AS unit_id FROM lesson WINDOW w AS (ORDER BY position)),
    n AS (SELECT l_orderkey * 10 + l_linenumber AS item_id, o.lesson_id, o.here, o.unit_id, CAST(max(l_quantity) AS BIGINT) AS need, l_returnflag AS op, concat(l_linestatus, CAST(l_linenumber AS VARCHAR)) AS token FROM lineitem JOIN o ON o.own = l_orderkey
          GROUP BY l_orderkey, l_linenumber, o.lesson_id, o.here, o.unit_id, l_returnflag, l_linestatus), i AS ({_INTRO}),
    q AS (SELECT item_id, lesson_id, here, unit_id, max(need) AS need FROM n GROUP BY ALL),
    qs AS (SELECT q.need, min(f.position) AS position FROM (SELECT DISTINCT need FROM q) q LEFT JOIN fact f ON f.dimension = 'quantity' AND f.num >= q.need GROUP BY q.need),
    v AS (SELECT q.item_id, q.lesson_id, q.unit_id, q.here, 'quantity' AS dimension, CAST(NULL AS VARCHAR) AS op, CAST(q.need AS VARCHAR) AS value, qs.position AS introduced FROM q JOIN qs ON qs.need = q.need WHERE qs.position IS NULL OR qs.position > q.here
          UNION ALL
          SELECT n.item_id, n.lesson_id, n.unit_id, n.here, 'flags', n.op, n.token, i.position FROM (SELECT DISTINCT item_id, lesson_id, here, unit_id, op, token FROM n) n JOIN i ON i.op = n.op AND i.token = n.token WHERE i.position > n.here)"""


def _checked(spark: SparkSession, sf_dir: str, **options: DataFrame) -> tuple[DataFrame, DataFrame]:
    lessons = frame(spark, sf_dir, "lesson").select("lesson_id", "position", "unit_id")
    placed = sequence.dense_position(lessons.select("lesson_id", "position"), ["position"], "n")
    before = placed.select((F.col("n") + 1).alias("n"), F.col("lesson_id").alias("before"))
    held = placed.join(before, "n", "left").select(F.col("lesson_id").alias("l_orderkey"), F.coalesce("before", "lesson_id").alias("lesson_id"))
    return _held(frame(spark, sf_dir, "lineitem").join(held, "l_orderkey"), frame(spark, sf_dir, "fact"), lessons, options)


def _held(lines: DataFrame, facts: DataFrame, lessons: DataFrame, options: dict) -> tuple[DataFrame, DataFrame]:
    item = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("item_id")
    quantity = lines.select(item, "lesson_id", F.lit("quantity").alias("dimension"), F.lit(None).cast("string").alias("op"), F.lit(None).cast("string").alias("token"), F.col("l_quantity").cast("long").alias("need"))
    flags = lines.select(item, "lesson_id", F.lit("flags").alias("dimension"), F.col("l_returnflag").alias("op"), F.concat("l_linestatus", F.col("l_linenumber").cast("string")).alias("token"), F.lit(None).cast("long").alias("need")).distinct()
    return lattice.check_items(quantity.unionByName(flags), facts, lessons, **options)


@query(_CHECK + " SELECT item_id, lesson_id, dimension, op, value, introduced FROM v")
def check_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir)[0].select("item_id", "lesson_id", "dimension", "op", "value", "introduced")


@query(_CHECK + """ , s AS (SELECT v.item_id, v.lesson_id, count(*) AS n, bool_and(coalesce(v.introduced > v.here AND l.unit_id = v.unit_id, FALSE)) AS soft FROM v LEFT JOIN lesson l ON l.position = v.introduced GROUP BY v.item_id, v.lesson_id)
    SELECT n.item_id, n.lesson_id, CASE WHEN s.n IS NULL THEN 'in' WHEN s.soft THEN 'borderline' ELSE 'out' END AS verdict, coalesce(s.n, 0) AS n_violations
    FROM (SELECT DISTINCT item_id, lesson_id FROM n) n LEFT JOIN s ON s.item_id = n.item_id AND s.lesson_id = n.lesson_id""")
def check_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir)[1].select("item_id", "lesson_id", "verdict", "n_violations")


@query(_CHECK + " SELECT item_id, lesson_id, dimension, op, value, introduced FROM v WHERE NOT (dimension = 'flags' AND value IN ('F1', 'O2'))")
def everyday_ignore_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with two tokens that are never looked at."""
    ignored = spark.createDataFrame([("flags", "F1"), ("flags", "O2")], "dimension string, token string")
    return _checked(spark, sf_dir, ignored=ignored)[0].select("item_id", "lesson_id", "dimension", "op", "value", "introduced")


# All kinds of needs: a line needs one of them, by its number; lines of large quantities grant some.
_LADDER = ["整数·表内", "整数·乘数一位数", "整数·乘数两位数", "整数·乘数三位数及以上"]
_ALL = f"""
    WITH g AS (SELECT l_linenumber AS k, l_suppkey AS s, l_partkey AS p, l.position FROM lineitem JOIN lesson l ON l.lesson_id = l_orderkey WHERE l_quantity >= 49),
    f AS (SELECT 'fraction_types' AS dimension, CAST(NULL AS VARCHAR) AS op, i.implied AS token, position FROM g JOIN (VALUES (0, '几分之一'), (1, '几分之几'), (1, '几分之一'), (2, '真分数'), (2, '几分之几'), (2, '几分之一'), (3, '带分数'), (3, '真分数'), (3, '几分之几'), (3, '几分之一')) AS i(n, implied) ON i.n = s % 4 WHERE k = 1
          UNION ALL SELECT 'operation_forms', '乘法', {_LADDER!r}[s % 4 + 1], position FROM g WHERE k = 2
          UNION ALL SELECT 'operation_forms', '加法', CASE WHEN s % 2 = 0 THEN '整数' ELSE '进位' END, position FROM g WHERE k = 3
          UNION ALL SELECT 'units_of_measure', NULL, concat('u', p % 5), position FROM g WHERE k = 4
          UNION ALL SELECT 'concepts', NULL, concat('c', p % 8), position FROM g WHERE k = 5),
    r AS (SELECT dimension, op, token, min(position) AS raw FROM f GROUP BY ALL),
    h(token, higher) AS (SELECT {_LADDER!r}[i], {_LADDER!r}[j] FROM range(1, 5) a(i), range(1, 5) b(j) WHERE j >= i UNION ALL VALUES ('整数', '整数'), ('整数', '进位'), ('进位', '进位')),
    t AS (SELECT h.token, min(raw) AS allowed FROM h LEFT JOIN r ON r.dimension = 'operation_forms' AND r.token = h.higher GROUP BY h.token),
    n AS (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS item_id, l_orderkey AS lesson_id, l.position AS here, l.unit_id,
          CASE l_linenumber WHEN 1 THEN 'fraction_types' WHEN 2 THEN 'operation_forms' WHEN 3 THEN 'operation_forms' WHEN 4 THEN 'units_of_measure' WHEN 5 THEN 'concepts' ELSE 'carry_or_borrow' END AS dimension, CASE l_linenumber WHEN 2 THEN '乘法' WHEN 3 THEN '加法' END AS op,
          CASE l_linenumber WHEN 1 THEN ['分数', '几分之几', '带分数'][l_suppkey % 3 + 1] WHEN 2 THEN {_LADDER!r}[l_suppkey % 4 + 1] WHEN 3 THEN CASE WHEN l_suppkey % 2 = 0 THEN '整数' ELSE '进位' END WHEN 4 THEN concat('u', l_partkey % 6) WHEN 5 THEN concat('c', l_partkey % 9) END AS token
          FROM lineitem JOIN lesson l ON l.lesson_id = l_orderkey),
    j AS (SELECT n.*, CASE WHEN n.token = '分数' THEN (SELECT min(raw) FROM r WHERE dimension = 'fraction_types') WHEN n.dimension = 'carry_or_borrow' THEN (SELECT min(raw) FROM r WHERE token = '进位') ELSE r.raw END AS raw,
          CASE WHEN n.token = '分数' THEN (SELECT min(raw) FROM r WHERE dimension = 'fraction_types') WHEN n.dimension = 'carry_or_borrow' THEN (SELECT min(raw) FROM r WHERE token = '进位') WHEN n.dimension = 'operation_forms' THEN t.allowed ELSE r.raw END AS allowed
          FROM n LEFT JOIN r ON r.dimension = n.dimension AND r.op IS NOT DISTINCT FROM n.op AND r.token = n.token LEFT JOIN t ON n.dimension = 'operation_forms' AND t.token = n.token),
    m AS (SELECT *, raw IS NULL AND allowed IS NULL AND dimension = 'concepts' AS doubt FROM j WHERE allowed IS NULL OR allowed > here),
    v AS (SELECT item_id, lesson_id, here, unit_id, dimension, op, CASE WHEN dimension = 'operation_forms' THEN string_agg(token, '、' ORDER BY token) ELSE coalesce(max(token), '进位/退位') END AS value, max(raw) AS introduced, doubt FROM m GROUP BY item_id, lesson_id, here, unit_id, dimension, op, CASE WHEN dimension <> 'operation_forms' THEN token END, token IS NULL, doubt)"""


def _every_dimension(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    lessons = frame(spark, sf_dir, "lesson").select("lesson_id", "position", "unit_id")
    lines = frame(spark, sf_dir, "lineitem").join(lessons, F.col("l_orderkey") == F.col("lesson_id"))
    k, s = F.col("l_linenumber"), F.col("l_suppkey")
    pick = lambda names, n: F.element_at(F.array(*map(F.lit, names)), (n % len(names) + 1).cast("int"))
    numbered = lambda letter, m: F.concat(F.lit(letter), (F.col("l_partkey") % m).cast("string"))
    forms, op = F.when(k == 2, pick(_LADDER, s)).when(k == 3, pick(["整数", "进位"], s)), F.when(k == 2, "乘法").when(k == 3, "加法")
    kind = lambda last: F.when(k == 1, "fraction_types").when(k <= 3, "operation_forms").when(k == 4, "units_of_measure").when(k == 5, "concepts").otherwise(last)
    granted = F.when(k == 1, pick(["几分之一", "几分之几", "真分数", "带分数"], s)).when(k == 4, numbered("u", 5)).when(k == 5, numbered("c", 8)).otherwise(forms)
    facts = lines.where("l_quantity >= 49 AND l_linenumber <= 5").select(kind(None).alias("dimension"), op.alias("op"), granted.alias("token"), F.lit(None).cast("long").alias("num"), "position")
    asked = F.when(k == 1, pick(["分数", "几分之几", "带分数"], s)).when(k == 4, numbered("u", 6)).when(k == 5, numbered("c", 9)).otherwise(forms)
    needs = lines.select((F.col("l_orderkey") * 10 + k).alias("item_id"), "lesson_id", kind("carry_or_borrow").alias("dimension"), op.alias("op"), asked.alias("token"), F.lit(None).cast("long").alias("need")).distinct()
    return lattice.check_items(needs, facts, lessons)


@query(_ALL + " SELECT item_id, lesson_id, dimension, op, value, introduced FROM v WHERE NOT doubt")
def check_every_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fractions, operand forms, units, concepts, carrying and borrowing, with what each token implies."""
    return _every_dimension(spark, sf_dir)[0]


@query(_ALL + """, c AS (SELECT item_id, CAST(count_if(NOT doubt) AS BIGINT) AS n_violations, CAST(count_if(doubt) AS BIGINT) AS n_unknown, bool_and(doubt OR coalesce(introduced > here AND l.unit_id = v.unit_id, FALSE)) AS soft FROM v LEFT JOIN (SELECT position, unit_id FROM lesson) l ON l.position = v.introduced GROUP BY item_id)
    SELECT i.item_id, CASE WHEN coalesce(n_violations, 0) = 0 THEN 'in' WHEN soft THEN 'borderline' ELSE 'out' END AS verdict, coalesce(n_violations, 0) AS n_violations, coalesce(n_unknown, 0) AS n_unknown FROM (SELECT DISTINCT item_id FROM n) i LEFT JOIN c ON c.item_id = i.item_id""")
def verdict_every_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _every_dimension(spark, sf_dir)[1].drop("lesson_id")


@query("""WITH s AS (SELECT position, max(num) AS top, list(concat(op, ':', token)) FILTER (WHERE token IS NOT NULL) AS flags FROM fact GROUP BY position), c AS (SELECT *, lead(top) OVER w AS top2, lead(flags) OVER w AS flags2, lead(position) OVER w AS follows FROM s WINDOW w AS (ORDER BY position))
    SELECT position FROM c WHERE follows IS NOT NULL AND NOT (coalesce(top, 0) <= coalesce(top2, 0) AND coalesce(list_has_all(flags2, flags), len(flags) = 0, TRUE))""")
def boundary_monotone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lessons whose own grants are not at most the next one's in the product order."""
    facts = frame(spark, sf_dir, "fact")
    state = facts.groupBy("position").agg(F.struct(F.max("num").alias("top"), F.array_sort(F.collect_set(F.when(F.col("token").isNotNull(), F.concat_ws(":", "op", "token")))).alias("flags")).alias("s"))
    placed = sequence.dense_position(state, ["position"], "place")
    following = placed.select((F.col("place") - 1).alias("place"), F.col("s").alias("next"))
    return placed.join(following, "place").where(~lattice.boundary_leq(F.col("s"), F.col("next"), ["top"], ["flags"])).select("position")


_COVERAGE = """WITH g AS (SELECT position, num FROM fact WHERE dimension = 'quantity'), i AS (SELECT l.lesson_id AS item_id, l.position, CAST(max(li.l_quantity) + 3 AS BIGINT) AS need FROM lineitem li JOIN lesson l ON li.l_orderkey = l.lesson_id GROUP BY l.lesson_id, l.position),
    u AS (SELECT position, num AS v, 0 AS kind, NULL AS item_id FROM g UNION ALL SELECT position, need, 1, item_id FROM i)"""


@query("""WITH g AS (SELECT position, num FROM fact WHERE dimension = 'quantity'), i AS (SELECT l.lesson_id AS item_id, l.position, CAST(max(li.l_quantity) + 3 AS BIGINT) AS need FROM lineitem li JOIN lesson l ON li.l_orderkey = l.lesson_id GROUP BY l.lesson_id, l.position),
    r AS (SELECT i.item_id, i.need, (SELECT max(num) FROM g) AS top, g.position FROM i JOIN g ON g.position = i.position), u AS (SELECT position, num AS v, 0 AS kind, NULL AS item_id FROM g UNION ALL SELECT position, need, 1, item_id FROM i)
    SELECT CAST(item_id AS VARCHAR) AS item_id, 'quantity' AS dimension, coalesce(b, 0) >= v AS ok, FALSE AS repaired FROM (SELECT *, max(CASE WHEN kind = 0 THEN v END) OVER (ORDER BY position, kind, CAST(item_id AS VARCHAR) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM u) WHERE kind = 1""")
def coverage_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coverage(spark, sf_dir, False)


@query(_COVERAGE + " SELECT CAST(item_id AS VARCHAR) AS item_id, 'quantity' AS dimension, coalesce(b, 0) >= v AS ok, coalesce(b, 0) < v AS repaired FROM (SELECT *, max(v) OVER (ORDER BY position, kind, CAST(item_id AS VARCHAR) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM u) WHERE kind = 1")
def coverage_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coverage(spark, sf_dir, True)


def _coverage(spark: SparkSession, sf_dir: str, repair: bool) -> DataFrame:
    grants = frame(spark, sf_dir, "fact").where("dimension = 'quantity'")
    items = frame(spark, sf_dir, "lineitem").join(frame(spark, sf_dir, "lesson"), F.col("l_orderkey") == F.col("lesson_id")).groupBy(F.col("lesson_id").cast("string").alias("item_id"), "position").agg((F.max("l_quantity") + 3).cast("long").alias("need"))
    return lattice.coverage_pass(items.withColumn("dimension", F.lit("quantity")), grants, repair)


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN v <= 100 THEN v ELSE CAST(power(10, length(CAST(v AS VARCHAR))) AS BIGINT) - 1 END AS grant_to FROM (SELECT l_orderkey, l_linenumber, l_partkey, CAST(floor(l_extendedprice) AS BIGINT) AS v FROM lineitem)")
def needed_grant(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frame(spark, sf_dir, "lineitem").withColumn("v", F.floor("l_extendedprice").cast("long"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", lattice.needed_grant(F.lit("integer_domain"), F.col("v").cast("string")).alias("grant_to"))


@query("SELECT l_returnflag, CAST(count_if(l_quantity > 25) AS BIGINT) AS over, CAST(count_if(l_quantity <= 25) AS BIGINT) AS within, CAST(count_if(l_discount = 0) AS BIGINT) AS no_discount FROM lineitem GROUP BY l_returnflag")
def crosscheck_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.crosscheck(frame(spark, sf_dir, "lineitem"), "l_returnflag", over=F.col("l_quantity") > 25, within=F.col("l_quantity") <= 25, no_discount=F.col("l_discount") == 0)


_DIGIT = "(a // CAST(power(10, i) AS BIGINT)) % 10"


@query("""
    WITH p AS (SELECT l_orderkey, l_linenumber, CAST(max(l_quantity) AS BIGINT) AS x, CAST(max(l_partkey) AS BIGINT) AS y FROM lineitem GROUP BY l_orderkey, l_linenumber), q AS (SELECT *, greatest(x, y) AS h, least(x, y) AS l FROM p)
    SELECT l_orderkey, l_linenumber, NOT (x + y <= 10 OR (x % 10 = 0 AND y % 10 = 0 AND x + y <= 100)) AND len(list_filter(range(0, 18), lambda i: (x // CAST(power(10, i) AS BIGINT)) % 10 + (y // CAST(power(10, i) AS BIGINT)) % 10 >= 10)) > 0 AS carry,
           NOT (h <= 10 OR (h % 10 = 0 AND l % 10 = 0)) AND len(list_filter(range(0, 18), lambda i: (h // CAST(power(10, i) AS BIGINT)) % 10 < (l // CAST(power(10, i) AS BIGINT)) % 10)) > 0 AS borrow,
           CAST(greatest(1, length(regexp_replace(CAST(y AS VARCHAR), '0+$', ''))) AS INTEGER) AS digits FROM q""")
def carry_borrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = frame(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").cast("long").alias("x"), F.max("l_partkey").alias("y"))
    x, y = F.col("x"), F.col("y")
    return p.select("l_orderkey", "l_linenumber", numbers.has_carry(x, y).alias("carry"), numbers.has_borrow(x, y).alias("borrow"), numbers.digits(y).alias("digits"))


@query("""
    WITH w AS (SELECT p_partkey, p_size AS s, CAST(round(p_retailprice * 100) AS BIGINT) AS c, CAST(p_retailprice AS VARCHAR) AS t FROM part)
    SELECT p_partkey, concat(CASE WHEN s % 3 = 0 THEN concat(s, '又') ELSE '' END, CASE WHEN s % 2 = 0 THEN concat(s, '/', s + 1) ELSE t END) AS written,
           CASE WHEN s % 6 = 0 THEN 'mixed' WHEN s % 2 = 0 THEN 'frac' WHEN s % 3 <> 0 THEN 'dec' END AS kind,
           CASE WHEN s % 6 = 0 THEN concat(s * s + 2 * s, '/', s + 1) WHEN s % 2 = 0 THEN concat(s, '/', s + 1) WHEN s % 3 <> 0 THEN CASE WHEN c % 100 = 0 THEN CAST(c // 100 AS VARCHAR) ELSE concat(c // gcd(c, 100), '/', 100 // gcd(c, 100)) END END AS value,
           CAST(CASE WHEN s % 2 = 0 THEN 0 WHEN s % 3 <> 0 THEN length(split_part(t, '.', 2)) END AS INTEGER) AS places, CASE WHEN s % 6 = 0 THEN '带分数' WHEN s % 2 = 0 THEN '几分之几' END AS fraction_type FROM w""")
def number_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices and sizes written as decimals, fractions and mixed numbers."""
    written = F.concat_ws("", F.when(F.col("p_size") % 3 == 0, F.concat(F.col("p_size"), F.lit("又"))), F.when(F.col("p_size") % 2 == 0, F.concat(F.col("p_size"), F.lit("/"), F.col("p_size") + 1)).otherwise(F.col("p_retailprice").cast("string")))
    rows = frame(spark, sf_dir, "part").select("p_partkey", written.alias("written"))
    return rows.withColumn("n", numbers.parse_number_udf("written")).select("p_partkey", "written", "n.*")


_SIGNIFICANT = "least(3, greatest(1, length(regexp_replace(CAST({0} AS VARCHAR), '0+$', ''))))"


@query(f"""
    WITH r AS (SELECT DISTINCT ['加法', '减法', '乘法', '除法'][l_linenumber % 4 + 1] AS op, CAST(l_quantity AS INTEGER) AS x, l_suppkey % 2 = 0 AS whole, l_suppkey AS y, CAST(l_discount AS VARCHAR) AS t FROM lineitem),
    d AS (SELECT *, greatest(x, y) AS h, least(x, y) AS l, len(list_filter(range(0, 9), lambda i: (x // CAST(power(10, i) AS BIGINT)) % 10 + (y // CAST(power(10, i) AS BIGINT)) % 10 >= 10)) > 0 AS over, {_SIGNIFICANT.format("x")} AS sx, {_SIGNIFICANT.format("y")} AS sy FROM r),
    e AS (SELECT *, len(list_filter(range(0, 9), lambda i: (h // CAST(power(10, i) AS BIGINT)) % 10 < (l // CAST(power(10, i) AS BIGINT)) % 10)) > 0 AS under FROM d),
    g AS (SELECT *, CASE WHEN whole AND op = '除法' AND y = 0 THEN NULL
        WHEN whole THEN CASE op WHEN '加法' THEN CASE WHEN over AND NOT (x + y <= 10 OR (x % 10 = 0 AND y % 10 = 0 AND x + y <= 100)) THEN ['整数', '进位'] ELSE ['整数'] END
            WHEN '减法' THEN CASE WHEN under AND NOT (h <= 10 OR (h % 10 = 0 AND l % 10 = 0)) THEN ['整数', '退位'] ELSE ['整数'] END
            WHEN '乘法' THEN CASE WHEN x <= 9 AND y <= 9 THEN ['整数·表内'] ELSE [['整数·乘数一位数', '整数·乘数两位数', '整数·乘数三位数及以上'][least(sx, sy)]] END
            ELSE list_concat(CASE WHEN x <= 81 AND y <= 9 THEN ['整数·表内'] ELSE [['整数·除数一位数', '整数·除数两位数', '整数·除数三位数及以上'][sy]] END, CASE WHEN y <> 0 AND x % y <> 0 THEN ['整数·有余数'] ELSE [] END) END
        ELSE CASE op WHEN '乘法' THEN ['小数·乘整数'] WHEN '除法' THEN ['小数·除数是小数'] ELSE ['小数', '小数·位数不同'] END END AS forms FROM e)
    SELECT DISTINCT op, CAST(x AS VARCHAR) AS a, CASE WHEN whole THEN CAST(y AS VARCHAR) ELSE t END AS b, array_to_string(list_sort(forms), ',') AS forms, CAST(CASE WHEN forms IS NULL THEN NULL WHEN whole THEN 0 ELSE length(split_part(t, '.', 2)) END AS INTEGER) AS places FROM g""")
def operand_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frame(spark, sf_dir, "lineitem").select(
        F.element_at(F.array(*(F.lit(o) for o in ("加法", "减法", "乘法", "除法"))), F.col("l_linenumber") % 4 + 1).alias("op"), F.col("l_quantity").cast("int").cast("string").alias("a"), F.when(F.col("l_suppkey") % 2 == 0, F.col("l_suppkey").cast("string")).otherwise(F.col("l_discount").cast("string")).alias("b")
    )
    found = rows.distinct().withColumn("r", numbers.analyse_operation_udf("op", "a", "b", F.lit(None).cast("string")))
    return found.select("op", "a", "b", F.array_join("r.forms", ",").alias("forms"), "r.places")
