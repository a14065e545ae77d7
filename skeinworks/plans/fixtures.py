"""How the star-schema tables stand in for a curriculum, as SQL that Spark and DuckDB both run.

An order is a lesson (ordered by date and key, which ``position`` encodes without a sort), a part a
knowledge point introduced by the first order that holds it, an order also an exercise whose first
line is its primary point. Prerequisites link neighbours of a thread in runs of eight, with some
shortcuts over one neighbour.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

#: name -> SQL; later ones build on earlier ones. {day} is the number of days since 1995-01-01.
VIEWS = {
    "lesson": """
        SELECT o_orderkey AS lesson_id, CAST(year(o_orderdate) - 1994 AS INT) AS grade,
               CASE WHEN month(o_orderdate) <= 6 THEN 'a' ELSE 'b' END AS semester,
               CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INT) AS unit_id,
               CAST(year(o_orderdate) * 10 + CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 2 END AS INT) AS book_id,
               CAST({day} AS BIGINT) * 1000000000 + o_orderkey AS position
        FROM orders""",
    "holds": "SELECT l_orderkey AS lesson_id, l_partkey AS kp_id, min(l_linenumber) AS line FROM lineitem GROUP BY l_orderkey, l_partkey",
    "first_seen": "SELECT h.kp_id, min(l.position) AS position, max(l.position) AS last_position FROM holds h JOIN lesson l ON h.lesson_id = l.lesson_id GROUP BY h.kp_id",
    "point": """
        SELECT p.p_partkey AS node, p.p_name AS name, p.p_brand AS thread, p.p_type AS domain, split_part(p.p_name, ' ', 1) AS topic,
               p.p_size AS size, p.p_retailprice AS price, f.position, l.lesson_id, l.grade, l.semester, l.unit_id, l.book_id
        FROM part p JOIN first_seen f ON p.p_partkey = f.kp_id JOIN lesson l ON l.lesson_id = f.position % 1000000000""",
    "ranked_point": "SELECT node, thread, domain, position, row_number() OVER (PARTITION BY thread, domain ORDER BY position, node) - 1 AS n FROM point",
    "edge": """
        SELECT a.node AS src, b.node AS dst, 'prerequisite' AS type
        FROM ranked_point a JOIN ranked_point b ON a.thread = b.thread AND a.domain = b.domain AND b.n > a.n AND b.n <= a.n + 2
        WHERE floor(a.n / 8.0) = floor(b.n / 8.0) AND (b.n = a.n + 1 OR a.n % 3 = 0)""",
    "first_line": "SELECT lesson_id AS item_id, min(CAST(line AS BIGINT) * 1000000000 + kp_id) % 1000000000 AS prim FROM holds GROUP BY lesson_id",
    "item_ref": "SELECT f.item_id, f.prim, h.kp_id AS other FROM first_line f JOIN holds h ON f.item_id = h.lesson_id AND f.prim <> h.kp_id",
    "fact": """
        SELECT 'quantity' AS dimension, CAST(NULL AS STRING) AS op, CAST(NULL AS STRING) AS token, CAST(max(li.l_quantity) AS BIGINT) AS num, l.position
        FROM lineitem li JOIN lesson l ON li.l_orderkey = l.lesson_id GROUP BY l.position
        UNION ALL
        SELECT 'flags' AS dimension, li.l_returnflag AS op, concat(li.l_linestatus, CAST(li.l_linenumber AS STRING)) AS token, CAST(NULL AS BIGINT) AS num, l.position
        FROM lineitem li JOIN lesson l ON li.l_orderkey = l.lesson_id GROUP BY li.l_returnflag, concat(li.l_linestatus, CAST(li.l_linenumber AS STRING)), l.position""",
}
_DAY = {"spark": "datediff(o_orderdate, DATE '1995-01-01')", "duckdb": "date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE))"}


def _mentions(text: str) -> list[str]:
    words = set(re.findall(r"\w+", text))
    return [n for n in (*BASE, *VIEWS) if n in words]


def views(spark: SparkSession, sf_dir: str, text: str) -> None:
    """Registers the tables and stand-ins that ``text`` mentions, directly or not, as temporary views (nothing is computed)."""
    needed: set[str] = set()
    todo = _mentions(text)
    while todo:
        n = todo.pop()
        if n not in needed:
            needed.add(n)
            todo += _mentions(VIEWS.get(n, ""))
    for n in BASE:
        if n in needed:
            spark.read.parquet(f"{sf_dir}/{n}.parquet").createOrReplaceTempView(n)
    for n, body in VIEWS.items():
        if n in needed:
            spark.sql(body.replace("{day}", _DAY["spark"])).createOrReplaceTempView(n)


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One stand-in; only the tables it needs are read."""
    views(spark, sf_dir, name)
    return spark.table(name)


def oracle(text: str) -> str:
    """DuckDB SQL of a query over the stand-ins."""
    head = ", ".join(f"{n} AS ({t.replace('{day}', _DAY['duckdb']).replace('STRING', 'VARCHAR')})" for n, t in VIEWS.items())
    body = text.strip()
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {head}, {body[len('WITH RECURSIVE'):]}"
    if body.upper().startswith("WITH"):
        return f"WITH {head}, {body[4:]}"
    return f"WITH {head} {body}"
