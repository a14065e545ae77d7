"""Text and retrieval queries, templates and generation."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinworks.functions import mining
from skeinworks.functions.generate import instantiate_many, instantiate_within
from skeinworks.operators import lattice, probes, retrieval, sparse_topk
from skeinworks.plans.catalogue import query
from skeinworks.plans.fixtures import frame

_RUNS = "regexp_extract_all(lower(text), '[a-z]+|[0-9]+(?:\\.[0-9]+)?')"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, dealt out over all tasks: a file of one row group is read by one."""
    docs = frame(spark, sf_dir, "documents").select("doc_id", "text", "source")
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return docs.repartition(tasks, F.xxhash64("doc_id", "text"))


@query(f"SELECT token, count(*) AS n, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest({_RUNS}) AS token FROM documents) GROUP BY token")
def word_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.token_counts(_documents(spark, sf_dir))


@query("SELECT g AS token, count(*) AS n, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest(list_transform(range(1, len(c)), lambda i: c[i] || c[i + 1])) AS g FROM (SELECT doc_id, string_split(regexp_replace(text, '\\s+', '', 'g'), '') AS c FROM documents)) GROUP BY g")
def bigram_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.token_counts(_documents(spark, sf_dir), retrieval.bigrams)


_GRAMS = "SELECT DISTINCT {key} AS {key}, substr(t, i, 5) AS g FROM (SELECT {key}, regexp_replace(text, '\\s+', '', 'g') AS t FROM {table}), LATERAL (SELECT unnest(range(1, length(t) - 3)) AS i) r"


@query("WITH b AS (" + _GRAMS.format(key="item_id", table="benchmark") + "), n AS (SELECT item_id, count(*) AS n FROM b GROUP BY item_id), d AS (SELECT item_id AS other, g FROM b), o AS (SELECT b.item_id, d.other, count(*) AS c FROM b JOIN d ON b.g = d.g WHERE b.item_id < d.other GROUP BY ALL) SELECT o.item_id, o.other, round(CAST(c AS DOUBLE) / n, 6) AS overlap FROM o JOIN n USING (item_id)")
def ngram_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items are paired through shared n-grams; the expression then compares each pair, whole."""
    b = frame(spark, sf_dir, "benchmark").withColumn("text", F.regexp_replace("text", r"\s+", ""))
    grams = b.select("item_id", F.explode(F.array_distinct(retrieval.character_ngrams(F.col("text"), 5))).alias("g"))
    pairs = grams.join(grams.withColumnRenamed("item_id", "other"), "g").where("item_id < other").select("item_id", "other").distinct()
    both = pairs.join(b.select("item_id", "text"), "item_id").join(b.select(F.col("item_id").alias("other"), F.col("text").alias("t2")), "other")
    return both.select("item_id", "other", F.round(retrieval.ngram_overlap(F.col("text"), F.col("t2")), 6).alias("overlap"))


_TF = f"""WITH t AS (SELECT item_id, token, count(*) AS tf FROM (SELECT doc_id AS item_id, unnest({_RUNS}) AS token FROM documents) GROUP BY ALL), n AS (SELECT count(*) AS n FROM documents), df AS (SELECT token, count(*) AS df FROM t GROUP BY token),
    w AS (SELECT item_id, token, (1 + ln(tf)) * (ln((1.0 + n) / (1 + df)) + 1) AS w FROM t JOIN df USING (token), n), u AS (SELECT item_id, token, w / sqrt(sum(w * w) OVER (PARTITION BY item_id)) AS w FROM w)"""


def _plain(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), "[^a-z0-9.]+", " ")


def _tokenised(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", retrieval.tokens(_plain(F.col("text"))).alias("tokens"))


def _weighted(docs: DataFrame) -> DataFrame:
    return retrieval.tfidf(docs.select("doc_id", _plain(F.col("text")).alias("tokens")))


@query(_TF + " SELECT item_id AS doc_id, token, round(w, 6) AS w FROM u")
def tfidf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weighted(_documents(spark, sf_dir)).select("doc_id", "token", F.round("w", 6).alias("w"))


@query(_TF + " SELECT a.item_id AS a, b.item_id AS b, round(sum(a.w * b.w), 6) AS sim FROM u a JOIN u b ON a.token = b.token AND a.item_id < b.item_id GROUP BY ALL")
def tfidf_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sparse_topk.all_pairs(_weighted(_documents(spark, sf_dir))).select("a", "b", F.round("sim", 6).alias("sim"))


@query(_TF + """, p AS (SELECT a.item_id AS a, b.item_id AS b, round(sum(a.w * b.w), 9) AS sim FROM u a JOIN u b ON a.token = b.token AND a.item_id <> b.item_id GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY sim DESC, b) AS n FROM p)
    SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b, 'similar' AS route FROM r WHERE n <= 3""")
def tfidf_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = sparse_topk.nearest_texts(_tokenised(_documents(spark, sf_dir)), 3)
    return near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.lit("similar").alias("route")).distinct()


@query(_TF + """, p AS (SELECT a.item_id AS a, b.item_id AS b, round(sum(a.w * b.w), 9) AS sim FROM u a JOIN u b ON a.token = b.token AND a.item_id <> b.item_id GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY sim DESC, b) AS n FROM p)
    SELECT a, b, round(sim, 6) AS sim, CAST(n AS INTEGER) AS place FROM r WHERE n <= 8""")
def nearest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight nearest of every document."""
    return sparse_topk.nearest_texts(_tokenised(_documents(spark, sf_dir)), 8).withColumn("sim", F.round(F.round("sim", 9), 6))


_ASKED = f"""WITH f AS (SELECT doc_id, 'desc' AS field, text FROM documents UNION ALL SELECT doc_id, 'thread', source FROM documents), t AS (SELECT doc_id, field, unnest({_RUNS}) AS token FROM f), l AS (SELECT doc_id, field, count(*) AS len FROM t GROUP BY ALL), m AS (SELECT field, CAST(sum(len) AS DOUBLE) / (SELECT count(*) FROM documents) AS mean FROM l GROUP BY field),
    c AS (SELECT doc_id, field, token, count(*) AS n FROM t GROUP BY ALL), v AS (SELECT token, doc_id, sum(CASE field WHEN 'desc' THEN 1.0 ELSE 1.5 END * n / (1 - 0.6 + 0.6 * len / mean)) AS v FROM c JOIN l USING (doc_id, field) JOIN m USING (field) GROUP BY ALL),
    d AS (SELECT token, count(*) AS df FROM v GROUP BY token), x AS (SELECT token, doc_id, v, df, ln(1 + ((SELECT count(*) FROM documents) - df + 0.5) / (df + 0.5)) AS idf FROM v JOIN d USING (token)),
    q AS (SELECT DISTINCT item_id AS query_id, unnest({_RUNS}) AS token FROM benchmark), s AS (SELECT query_id, doc_id, sum(idf * v * 2.4 / (v + 1.4)) AS score FROM q JOIN x USING (token) GROUP BY ALL)"""


def _searched(spark: SparkSession, sf_dir: str, k: int) -> sparse_topk.TopProducts:
    docs = _documents(spark, sf_dir)
    fields = docs.select("doc_id", F.lit("desc").alias("field"), _plain(F.col("text")).alias("tokens")).union(docs.select("doc_id", F.lit("thread"), _plain(F.col("source"))))
    requests = frame(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.lit(0).alias("clause"), F.lit(1.0).alias("weight"), retrieval.tokens(_plain(F.col("text"))).alias("tokens"))
    wanted = requests.select(F.explode("tokens").alias("token")).distinct()
    return sparse_topk.search_all(requests, retrieval.bm25f_index(fields, {"desc": 1.0, "thread": 1.5}, wanted=wanted), k)


@query(_ASKED + " SELECT query_id, doc_id, round(round(score, 9), 6) AS score, place FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS INTEGER) AS place FROM s WHERE score > 0) WHERE place <= 10")
def requests_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item, all items at once."""
    return _searched(spark, sf_dir, 10).results().withColumn("score", F.round(F.round("score", 9), 6))


@query(_ASKED + " SELECT query_id, count(*) AS n_terms, CAST(sum(df) AS BIGINT) AS entries FROM q JOIN d USING (token) GROUP BY query_id")
def requests_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lists that each item has; ``reads`` also tells those read whole."""
    return _searched(spark, sf_dir, 10).lists()


# Field-weighted search: benchmark items as queries over names, brands and types of parts.
_INDEX = """WITH f AS (SELECT p_partkey AS doc_id, 'name' AS field, p_name AS text FROM part UNION ALL SELECT p_partkey, 'thread', concat(p_brand, ' ', p_type) FROM part),
    t AS (SELECT doc_id, field, unnest(regexp_extract_all(lower(text), '[a-z]+|[0-9]+')) AS token FROM f), l AS (SELECT doc_id, field, count(*) AS len FROM t GROUP BY ALL), m AS (SELECT field, CAST(sum(len) AS DOUBLE) / (SELECT count(*) FROM part) AS mean FROM l GROUP BY field),
    c AS (SELECT doc_id, field, token, count(*) AS n FROM t GROUP BY ALL), v AS (SELECT token, doc_id, sum(CASE field WHEN 'name' THEN 3.0 ELSE 1.5 END * n / (1 - 0.6 + 0.6 * len / mean)) AS v FROM c JOIN l USING (doc_id, field) JOIN m USING (field) GROUP BY ALL),
    d AS (SELECT token, count(*) AS df FROM v GROUP BY token), x AS (SELECT token, doc_id, v, ln(1 + ((SELECT count(*) FROM part) - df + 0.5) / (df + 0.5)) AS idf FROM v JOIN d USING (token)),
    q AS (SELECT query_id, clause, weight, unnest(list_distinct(string_split(text, ' '))) AS token FROM (VALUES (1, 0, 1.0, 'small red widget'), (1, 1, 0.4, 'promo'), (2, 0, 1.0, 'blue bolt brand 4'), (3, 0, 0.45, 'economy ring ring')) AS z(query_id, clause, weight, text)),
    s AS (SELECT query_id, doc_id, sum(weight * idf * v * 2.4 / (v + 1.4)) AS score FROM q JOIN x USING (token) GROUP BY ALL)"""
_QUERIES = [(1, 0, 1.0, "small red widget"), (1, 1, 0.4, "promo"), (2, 0, 1.0, "blue bolt brand 4"), (3, 0, 0.45, "economy ring ring")]


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = frame(spark, sf_dir, "part")
    fields = part.select(F.col("p_partkey").alias("doc_id"), F.lit("name").alias("field"), retrieval.tokens(F.col("p_name")).alias("tokens")).union(part.select("p_partkey", F.lit("thread"), retrieval.tokens(F.concat_ws(" ", "p_brand", "p_type"))))
    queries = spark.createDataFrame(_QUERIES, "query_id int, clause int, weight double, text string").withColumn("tokens", retrieval.tokens(F.col("text")))
    return retrieval.lexical_scores(queries, retrieval.bm25f_index(fields, {"name": 3.0, "thread": 1.5}))


@query(_INDEX + " SELECT query_id, doc_id, round(score, 6) AS score FROM s")
def bm25f_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir).select("query_id", "doc_id", F.round("score", 6).alias("score"))


@query(_INDEX + " SELECT query_id, doc_id, place FROM (SELECT query_id, doc_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS INTEGER) AS place FROM s WHERE score > 0) WHERE place <= 10")
def bm25f_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.ranked(_scores(spark, sf_dir), 10, ["query_id"]).select("query_id", "doc_id", "place")


_POOLED = [(1, "small red widget", 3, None), (2, "red", None, "Brand#1"), (3, "bolt 4", 9, "Brand#2")]


@query("""WITH f AS (SELECT p_partkey AS doc_id, 3.2 AS w, p_name AS text FROM part UNION ALL SELECT p_partkey, 1.4, concat(p_brand, ' ', p_type) FROM part),
    t AS (SELECT doc_id, w, unnest(regexp_extract_all(lower(text), '[a-z]+|[0-9]+')) AS token FROM f), n AS (SELECT doc_id, CAST(sum(w) AS DOUBLE) AS len FROM t GROUP BY ALL), a AS (SELECT avg(coalesce(len, 0)) AS mean, count(*) AS n_docs FROM part LEFT JOIN n ON doc_id = p_partkey),
    c AS (SELECT doc_id, token, CAST(sum(w) AS DOUBLE) AS f FROM t GROUP BY ALL), d AS (SELECT token, count(*) AS df FROM c GROUP BY token),
    z AS (SELECT * FROM (VALUES (1, 'small red widget', 3, NULL), (2, 'red', NULL, 'Brand#1'), (3, 'bolt 4', 9, 'Brand#2')) AS v(query_id, text, size, brand)), q AS (SELECT query_id, unnest(list_distinct(string_split(text, ' '))) AS token FROM z),
    s AS (SELECT query_id, c.doc_id, sum(ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * f * 2.4 / (f + 1.4 * (1 - 0.72 + 0.72 * len / mean)) * CASE WHEN length(q.token) = 2 THEN 1.25 ELSE 1 END) AS score FROM q JOIN c ON c.token = q.token JOIN d ON d.token = q.token JOIN n ON n.doc_id = c.doc_id CROSS JOIN a GROUP BY ALL)
    SELECT s.query_id, s.doc_id, round(score * CASE WHEN size IS NULL THEN 1.0 WHEN size = p_size THEN 1.9 ELSE 0.5 END * CASE WHEN brand IS NULL THEN 1.0 WHEN brand = p_brand THEN 1.4 ELSE 0.8 END * CASE WHEN contains(p_name, replace(z.text, ' ', '')) THEN 1.5 ELSE 1.0 END, 6) AS score
    FROM s JOIN z ON z.query_id = s.query_id JOIN part ON p_partkey = s.doc_id""")
def pooled_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = frame(spark, sf_dir, "part")
    fields = part.select(F.col("p_partkey").alias("doc_id"), F.lit("name").alias("field"), retrieval.tokens(F.col("p_name")).alias("tokens")).union(part.select("p_partkey", F.lit("thread"), retrieval.tokens(F.concat_ws(" ", "p_brand", "p_type"))))
    asked = spark.createDataFrame(_POOLED, "query_id int, text string, size int, brand string")
    found = retrieval.pooled_scores(asked.select("query_id", retrieval.tokens(F.col("text")).alias("tokens")), fields)
    factor = retrieval.scope_factor((F.col("p_size"), F.col("size"), retrieval.GRADE_FACTORS), (F.col("p_brand"), F.col("brand"), retrieval.DOMAIN_FACTORS)) * retrieval.named_factor(F.col("p_name"), F.col("text"))
    placed = found.join(F.broadcast(asked), "query_id").join(part.select(F.col("p_partkey").alias("doc_id"), "p_size", "p_brand", "p_name"), "doc_id")
    return placed.select("query_id", "doc_id", F.round(F.col("score") * factor, 6).alias("score"))


_PRIOR = "CASE WHEN grade <= 3 AND 3 <= last_grade THEN CASE WHEN grade = 3 THEN CASE WHEN semester = 'a' THEN 1.2 * 1.1 ELSE 1.2 END ELSE 1.0 END WHEN grade > 3 THEN power(0.6, grade - 3) ELSE power(0.8, 3 - last_grade) END"
_SPAN = "SELECT p.node, p.grade, p.semester, CAST(max(l.grade) AS INT) AS last_grade FROM point p JOIN holds h ON h.kp_id = p.node JOIN lesson l ON l.lesson_id = h.lesson_id GROUP BY p.node, p.grade, p.semester"


@query(f"SELECT node, round({_PRIOR}, 6) AS prior FROM ({_SPAN})")
def grade_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame(spark, sf_dir, "point")
    rows = spark.sql(_SPAN)
    return rows.select("node", F.round(retrieval.grade_prior(F.col("grade"), F.col("last_grade"), F.lit(3), F.col("semester") == "a", F.lit(True)), 6).alias("prior"))


_DENSE = "SELECT 1 AS query_id, e.vec_id AS doc_id, list_inner_product(list_transform(e.embedding, lambda x: CAST(x AS DOUBLE)), list_transform(q.embedding, lambda x: CAST(x AS DOUBLE))) AS dense, CAST((e.vec_id * 7919) % 101 AS DOUBLE) AS lexical FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) q"


def _dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = frame(spark, sf_dir, "embeddings")
    q = e.where("vec_id = 0").select(F.col("embedding").alias("q")).limit(1)
    dot = F.aggregate(F.zip_with("embedding", "q", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda s, x: s + x)
    return e.crossJoin(F.broadcast(q)).select(F.lit(1).alias("query_id"), F.col("vec_id").alias("doc_id"), dot.alias("dense"), (F.col("vec_id") * 7919 % 101).cast("double").alias("lexical"))


@query(f"""WITH d AS ({_DENSE}), a AS (SELECT *, greatest(dense - avg(dense) OVER (), 0.0) AS g FROM d) SELECT doc_id, round(0.5 * (CASE WHEN max(lexical) OVER () > 0 THEN lexical / max(lexical) OVER () ELSE lexical END) + 0.5 * (CASE WHEN max(g) OVER () > 0 THEN g / max(g) OVER () ELSE g END), 6) AS fused FROM a""")
def search_fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.fused(_dense(spark, sf_dir)).select("doc_id", F.round("fused", 6).alias("fused"))


@query("""SELECT vec_id AS doc_id, round(list_cosine_similarity(list_transform(embedding, lambda x: CAST(x AS DOUBLE)), list_transform((SELECT embedding FROM embeddings WHERE vec_id = 0), lambda x: CAST(x AS DOUBLE))), 6) AS sim FROM embeddings""")
def cosine_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = frame(spark, sf_dir, "embeddings")
    q = e.where("vec_id = 0").select(F.col("embedding").alias("q")).limit(1)
    return e.crossJoin(F.broadcast(q)).select(F.col("vec_id").alias("doc_id"), F.round(retrieval.cosine(F.col("embedding"), F.col("q")), 6).alias("sim"))


@query("SELECT node, CAST(CASE WHEN size % 6 <> 0 AND domain IN ('PROMO', 'SMALL') THEN CASE WHEN grade <> 3 THEN 0.05 WHEN semester <> 'b' THEN 0.5 ELSE 1.0 END ELSE 0.0 END AS DOUBLE) AS score FROM point")
def search_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = retrieval.scope_score(F.col("grade"), F.col("semester"), F.lit(3), F.lit("b"), F.col("domain").isin("PROMO", "SMALL"), F.col("size") % 6 != 0)
    return frame(spark, sf_dir, "point").select("node", score.alias("score"))


@query("""WITH r AS (SELECT node, thread, price, row_number() OVER (PARTITION BY thread ORDER BY price DESC, node) - 1 AS i FROM point), a AS (SELECT node, price * power(0.8, i) AS s FROM r), t AS (SELECT node, CAST(row_number() OVER (ORDER BY round(s, 9) DESC, node) AS INTEGER) AS place FROM a) SELECT node, place FROM t WHERE place <= 50""")
def diversify(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = frame(spark, sf_dir, "point").select(F.col("node").alias("doc_id"), "thread", F.col("price").alias("score"))
    return retrieval.diversified(scores, 50).select(F.col("doc_id").alias("node"), "place")


@query("SELECT p_partkey AS node, regexp_replace(p_name, '(widget|ring|red)', '<mark>\\1</mark>', 'g') AS marked FROM part")
def highlight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, "part").select(F.col("p_partkey").alias("node"), retrieval.highlighted(F.col("p_name"), ["red", "ring", "widget"]).alias("marked"))


@query("SELECT doc_id, lower(regexp_replace(text, '[^\\p{L}\\p{N}]+', '', 'g')) AS term FROM documents")
def normal_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null text has a null term."""
    return frame(spark, sf_dir, "documents").select("doc_id", mining.normal_terms(F.col("text")).alias("term"))


#: Words of the benchmark's items that serve as a vocabulary at most; more are an error.
WORDS = 1_000_000


@query()
def mined_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Longer words of the benchmark's items that each whole text holds, across words and punctuation."""
    words = frame(spark, sf_dir, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit(r"(\w{6,})"))).alias("w")).distinct().limit(WORDS + 1).collect()
    if len(words) > WORDS:
        raise ValueError(f"more than {WORDS} words")
    found = mining.terms_in(F.col("text"), mining.term_forms(r.w for r in words))
    return _documents(spark, sf_dir).select("doc_id", found.alias("f")).select("doc_id", F.size("f").alias("n_terms"), F.array_join("f", ",").alias("terms"))


#: Units as they are told by name and aliases, for the queries.
UNITS = {"厘米": ["cm"], "米": ["m"], "千克": ["kg", "公斤"], "分钟": ["min"], "时": ["小时", "h"], "角": [], "秒": ["s"], "度": ["°"]}


@query()
def mined_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written operations, fraction types and units of each whole text."""
    t = F.col("text")
    return _documents(spark, sf_dir).select("doc_id", F.to_json(mining.operations_in(t)).alias("operations"), F.array_join(mining.fraction_types_in(t), ",").alias("fraction_types"), F.array_join(mining.units_in(t, mining.unit_forms(UNITS)), ",").alias("units"))


# Templates: one card of each size of part, seeds by part.
def _cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots = {"a": {"type": "int", "min": 1, "max": 40}, "b": {"type": "int", "min": 2, "max": 12}, "c": {"type": "fraction", "min": "0", "max": "1", "max_denominator": 8}}
    card = json.dumps({"template": "{a}÷{b}+{c}={answer}", "slots": slots, "constraints": ["a % b == 0", "a > b"], "answer": "a/b+c"})
    return frame(spark, sf_dir, "part").select(F.concat(F.lit("card-"), "p_size").alias("card_id"), F.lit(card).alias("card"), F.col("p_partkey").alias("seed"))


@query()
def instantiated_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return instantiate_many(_cards(spark, sf_dir))


@query()
def generation_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of seeds that give an exercise, and the share whose integers stay within 30."""
    made = instantiate_many(_cards(spark, sf_dir))
    top = F.get_json_object("params", "$.a").cast("int")
    return made.groupBy("card_id").agg(F.count(F.lit(1)).alias("n"), F.count("problem").alias("made"), F.count_if(top <= 30).alias("in_bounds"))


@query()
def bounds_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exercises of each card held against an early lesson, whose bound is the largest quantity so far."""
    cards = _cards(spark, sf_dir).select("card_id", "card").distinct()
    facts = frame(spark, sf_dir, "fact").withColumn("dimension", F.when(F.col("dimension") == "quantity", "integer_domain").otherwise(F.col("dimension")))
    lessons = frame(spark, sf_dir, "lesson").select("lesson_id", "position", "unit_id")
    first = lessons.agg(F.min_by("lesson_id", "position").alias("lesson_id"))
    return probes.bounds_probe(probes.generated_needs(cards), cards.select("card_id").crossJoin(F.broadcast(first)), facts, lessons)


@query()
def instantiated_in_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An exercise for each point, within the boundary of the lesson that introduces it; every fourth one within that of the first lesson."""
    slots = {"a": {"type": "int", "min": 1, "max": 60}, "b": {"type": "int", "min": 2, "max": 12}}
    card = json.dumps({"template": "{a}÷{b}={answer}", "slots": slots, "constraints": ["any([a % x == 0 for x in range(2, b + 1)])", "a > b"], "solver": "def solve(a, b):\n    return Fraction(a, b)"})
    facts = frame(spark, sf_dir, "fact").withColumn("dimension", F.when(F.col("dimension") == "quantity", "integer_domain").otherwise(F.col("dimension")))
    lessons = frame(spark, sf_dir, "lesson").select("lesson_id", "position", "unit_id")
    first = lessons.agg(F.min_by("lesson_id", "position").alias("first"))
    points = frame(spark, sf_dir, "point").crossJoin(F.broadcast(first))  # one row
    asked = points.select(F.concat(F.lit("card-"), "size").alias("card_id"), F.lit(card).alias("card"), F.col("node").alias("seed"), F.when(F.col("node") % 4 == 0, F.col("first")).otherwise(F.col("lesson_id")).alias("lesson_id"))
    return instantiate_within(asked, lattice.snapshots(facts, lessons))
