"""The query façade: a curriculum knowledge base over DataFrames, read only.

Tables (a dict of DataFrames, missing ones are empty): ``books``, ``units``, ``lessons``, ``points``
(knowledge points), ``cards`` (item templates), ``edges``, ``contexts``, ``glossary``, ``facts``
(capabilities as ``dimension, op, token, num, position``). Every method returns a DataFrame in a
defined order; single-row look-ups raise ``KeyError`` for an unknown id.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from skeinworks.operators import graph, lattice, retrieval
from skeinworks.operators.sequence import dense_position
from skeinworks.sources.files import read_optional

SCHEMAS = {
    "books": "id string, grade int, semester string, title string, seq_pos int",
    "units": "id string, book_id string, index int, title string",
    "lessons": "id string, unit_id string, index int, title string, summary string",
    "points": "id string, name string, aliases array<string>, domain string, thread string, topic string, description string, introduced_in string, review_lesson_ids array<string>, is_assessable boolean, mastery string, provenance string",
    "cards": "id string, primary_id string, secondary_ids array<string>, verifiable_type string, item_form string, difficulty int, source_ids array<string>, context_ids array<string>, template string, slots string, constraints array<string>, solver string, answer string",
    "edges": "id string, type string, src string, dst string, is_direct boolean, confidence double",
    "contexts": "id string, theme string, variants array<string>, quantities array<string>, grades array<int>",
    "glossary": "term string, aliases array<string>, definition string, seq int",
    "facts": "dimension string, op string, token string, num bigint, position bigint",
}


class Curriculum:
    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame]):
        self.spark = spark
        self.t = {name: tables.get(name, spark.createDataFrame([], schema)) for name, schema in SCHEMAS.items()}
        self._positions: DataFrame | None = None
        self._index: DataFrame | None = None
        self._embed = None

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> Curriculum:
        """Tables from ``folder/<name>.json`` (one array each); absent files are empty tables."""
        return cls(spark, {name: read_optional(spark, f"{folder}/{name}.json", schema) for name, schema in SCHEMAS.items()})

    # ---- sequence and places

    def places(self) -> DataFrame:
        """Lessons with unit, book and dense position: by book sequence, unit, lesson, id; unknown books come last."""
        if self._positions is None:
            u = self.t["units"].select(F.col("id").alias("unit_id"), "book_id", F.col("index").alias("unit_index"), F.col("title").alias("unit_title"))
            b = self.t["books"].select(F.col("id").alias("book_id"), "grade", "semester", F.col("title").alias("book_title"), "seq_pos")
            rows = self.t["lessons"].select(F.col("id").alias("lesson_id"), "unit_id", F.col("index").alias("lesson_index"), F.col("title").alias("lesson_title")).join(u, "unit_id", "left").join(b, "book_id", "left")
            keyed = rows.withColumn("_b", F.coalesce("seq_pos", F.lit(1 << 30))).withColumn("_u", F.coalesce("unit_index", F.lit(0))).withColumn("unit_title", F.coalesce("unit_title", "unit_id"))
            self._positions = dense_position(keyed, ["_b", "_u", "lesson_index", "lesson_id"]).drop("_b", "_u")
        return self._positions

    def _one(self, df: DataFrame, key: object) -> Row:
        got = df.limit(1).collect()
        if not got:
            raise KeyError(key)
        return got[0]

    def lesson_ids(self) -> DataFrame:
        return self.places().orderBy("position").select("lesson_id")

    def lesson_position(self, lesson_id: str) -> int:
        return self._one(self.places().where(F.col("lesson_id") == lesson_id), lesson_id).position

    def lesson(self, lesson_id: str) -> Row:
        return self._one(self.t["lessons"].where(F.col("id") == lesson_id), lesson_id)

    def lessons_of(self, book: str | None = None, unit: str | None = None) -> DataFrame:
        rows = self.places()
        if book:
            rows = rows.where(F.col("lesson_id").startswith(book + "."))
        if unit:
            rows = rows.where(F.col("unit_id") == unit)
        return rows.orderBy("position").select("lesson_id")

    def located(self) -> DataFrame:
        """Points with the place of their first lesson and a label."""
        rows = self.t["points"].withColumnRenamed("id", "kp_id").join(self.places().withColumnRenamed("lesson_id", "introduced_in"), "introduced_in", "left")
        return rows.withColumn("label", F.concat_ws(" / ", "book_title", "unit_title", "lesson_title"))

    def locate(self, kp_id: str) -> Row:
        return self._one(self.located().where(F.col("kp_id") == kp_id), kp_id)

    # ---- points

    def kp(self, kp_id: str) -> Row:
        return self._one(self.t["points"].where(F.col("id") == kp_id), kp_id)

    def find_kp(self, name: str) -> DataFrame:
        name = name.strip()
        return self.t["points"].where((F.col("name") == name) | F.array_contains("aliases", name)).orderBy("id")

    def kps(self, grade: int | None = None, domain: str | None = None, thread: str | None = None, book: str | None = None, assessable: bool | None = None, verifiable_type: str | None = None) -> DataFrame:
        rows = self.located()
        tests = [(domain, "domain"), (thread, "thread"), (assessable, "is_assessable"), (grade, "grade"), (book, "book_id")]
        for value, column in tests:
            if value is not None:
                rows = rows.where(F.col(column) == value)
        if verifiable_type is not None:
            cards = self.t["cards"].where(F.col("verifiable_type") == verifiable_type).select(F.col("primary_id").alias("kp_id"))
            rows = rows.join(cards, "kp_id", "left_semi")
        return rows.orderBy("position", "kp_id")

    def learned_before(self, lesson_id: str, inclusive: bool = False, domain: str | None = None, grade: int | None = None) -> DataFrame:
        at = self.lesson_position(lesson_id)
        rows = self.located().where(F.col("position") <= at if inclusive else F.col("position") < at)
        rows = rows if domain is None else rows.where(F.col("domain") == domain)
        rows = rows if grade is None else rows.where(F.col("grade") == grade)
        return rows.orderBy("position", "kp_id")

    def not_yet_learned(self, lesson_id: str) -> DataFrame:
        return self.t["points"].withColumnRenamed("id", "kp_id").join(self.learned_before(lesson_id, inclusive=True).select("kp_id"), "kp_id", "left_anti").orderBy("kp_id")

    # ---- cards, contexts, glossary

    def card_grades(self) -> DataFrame:
        """Distinct grades of each card's sources (second part of the id), else of its point."""
        own = F.array_sort(F.array_distinct(F.transform("source_ids", lambda s: F.substring(F.split(s, r"\.")[1], 2, 1).cast("int"))))
        point = self.located().select(F.col("kp_id").alias("primary_id"), F.col("grade").alias("_g"))
        return self.t["cards"].join(point, "primary_id", "left").withColumn("grades", F.when(F.size("source_ids") > 0, own).when(F.col("_g").isNotNull(), F.array("_g")).otherwise(F.array().cast("array<int>"))).drop("_g")

    def archetypes(self, kp_id=None, domain=None, grade=None, verifiable_type=None, item_form=None, difficulty: tuple[int, int] | None = None, include_secondary: bool = False) -> DataFrame:
        rows = self.card_grades()
        if kp_id is not None:
            mine = F.col("primary_id") == kp_id
            rows = rows.where(mine | F.array_contains("secondary_ids", kp_id) if include_secondary else mine)
        if domain is not None:
            rows = rows.join(self.t["points"].where(F.col("domain") == domain).select(F.col("id").alias("primary_id")), "primary_id", "left_semi")
        if grade is not None:
            rows = rows.where(F.array_contains("grades", grade))
        for value, column in ((verifiable_type, "verifiable_type"), (item_form, "item_form")):
            rows = rows if value is None else rows.where(F.col(column) == value)
        if difficulty is not None:
            rows = rows.where(F.col("difficulty").between(*difficulty))
        return rows.orderBy("primary_id", "id")

    def archetype(self, card_id: str) -> Row:
        return self._one(self.t["cards"].where(F.col("id") == card_id), card_id)

    def archetype_lessons(self) -> DataFrame:
        """``card_id, lessons`` in sequence: the lessons of its sources that are known, else its point's first lesson."""
        own = self.t["cards"].select(F.col("id").alias("card_id"), F.explode("source_ids").alias("s")).withColumn("lesson_id", F.regexp_extract("s", r"^ex\.(.+)\.[^.]+$", 1))
        point = self.t["cards"].where(F.size("source_ids") <= 0).join(self.t["points"].select(F.col("id").alias("primary_id"), F.col("introduced_in").alias("lesson_id")), "primary_id").select(F.col("id").alias("card_id"), "lesson_id")
        each = own.select("card_id", "lesson_id").unionByName(point).distinct().join(self.places().select("lesson_id", "position"), "lesson_id")
        return each.groupBy("card_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "lesson_id"))), lambda s: s["lesson_id"]).alias("lessons"))

    def contexts(self, grade: int | None = None, text: str | None = None) -> DataFrame:
        rows = self.t["contexts"]
        if grade is not None:
            rows = rows.where((F.size(F.coalesce("grades", F.array().cast("array<int>"))) == 0) | F.array_contains("grades", grade))
        if text is not None:
            rows = rows.where(F.concat_ws(" ", "theme", "variants", "quantities").contains(text))
        return rows.orderBy("id")

    def context(self, context_id: str) -> Row:
        return self._one(self.t["contexts"].where(F.col("id") == context_id), context_id)

    def contexts_for(self, card_id: str) -> DataFrame:
        refs = self.t["cards"].where(F.col("id") == card_id).select(F.posexplode("context_ids").alias("n", "id"))
        return refs.join(self.t["contexts"], "id").orderBy("n").drop("n")

    def glossary(self, term: str) -> DataFrame:
        return self.t["glossary"].where((F.col("term") == term) | F.array_contains("aliases", term)).orderBy("seq").limit(1)

    def glossary_search(self, text: str) -> DataFrame:
        """Entries whose term or some alias occurs in the text, longer terms first."""
        hit = F.lit(text).contains(F.col("term")) | F.exists(F.coalesce("aliases", F.array().cast("array<string>")), lambda a: (a != "") & F.lit(text).contains(a))
        return self.t["glossary"].where(hit).orderBy(F.desc(F.length("term")), "seq")

    # ---- graph

    def _edges(self, types: tuple[str, ...] = ("prerequisite",), implied: bool = False) -> DataFrame:
        e = self.t["edges"].where(F.col("type").isin(*types))
        e = e if implied else e.where(F.coalesce("is_direct", F.lit(True)))
        return graph.adjacency(e, self.t["points"], "id")

    def chain(self, kp_id: str, direction: str = "prerequisite", depth: int | None = None, edge_types: tuple[str, ...] = ("prerequisite",), include_implied: bool = False) -> DataFrame:
        """Points reached from one (backwards for ``prerequisite``), by breadth: ``kp_id, depth, via``."""
        self.kp(kp_id)
        start = self.spark.createDataFrame([(kp_id,)], "start string")
        got = graph.reach(self._edges(edge_types, include_implied), start, depth, backwards=direction == "prerequisite")
        return got.select(F.col("node").alias("kp_id"), "depth", "via").orderBy("depth", "kp_id")

    def prerequisites(self, kp_id: str, depth: int | None = None) -> DataFrame:
        return self.chain(kp_id, "prerequisite", depth)

    def dependents(self, kp_id: str, depth: int | None = None) -> DataFrame:
        return self.chain(kp_id, "dependent", depth)

    def relations(self, kp_id: str, types: tuple[str, ...] = ("related", "confusable", "extends")) -> DataFrame:
        rows = graph.relations(self.t["edges"].where(F.col("type").isin(*types)), "kp_id")
        return rows.where(F.col("kp_id") == kp_id).orderBy("type", "other", "direction")

    def review_candidates(self, lesson_id: str, targets: list[str] | None = None) -> DataFrame:
        """Points learned before a lesson; with targets only their prerequisites, nearest first, later introduced ones first."""
        known = self.learned_before(lesson_id)
        if not targets:
            return known.orderBy(F.desc("position"), "kp_id")
        starts = self.spark.createDataFrame([(t,) for t in targets], "start string")
        near = graph.reach(self._edges(), starts, None, backwards=True).groupBy(F.col("node").alias("kp_id")).agg(F.min("depth").alias("depth"))
        return known.join(near, "kp_id").orderBy("depth", F.desc("position"), "kp_id")

    # ---- boundary

    def boundary(self, lesson_id: str) -> DataFrame:
        at = self.spark.createDataFrame([(self.lesson_position(lesson_id),)], "position bigint")
        return lattice.boundary_at(lattice.closed_fractions(self.t["facts"]), at).drop("position").orderBy("dimension", "op", "token")

    def check_items(self, needs: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
        return lattice.check_items(needs, self.t["facts"], self.places().select("lesson_id", "position", "unit_id"), **options)

    # ---- retrieval

    def set_embedder(self, scores) -> None:
        """``scores(queries, points)``: a function of DataFrames to ``query_id, doc_id, dense``; without one search is lexical."""
        self._embed = scores

    def _fields(self) -> DataFrame:
        p = self.located()
        texts = {"name": F.col("name"), "alias": F.concat_ws(" ", "aliases"), "thread": F.concat_ws(" ", "thread", "topic"), "desc": F.col("description"), "lesson": F.concat_ws(" ", "lesson_title", "unit_title")}
        each = F.explode(F.array(*(F.struct(F.lit(k).alias("field"), retrieval.tokens(v).alias("tokens")) for k, v in texts.items()))).alias("f")
        return p.select(F.col("kp_id").alias("doc_id"), each).select("doc_id", "f.field", "f.tokens")

    def search(self, query: str, k: int = 10, *, grade: int | None = None, domain: str | None = None, verifiable_type: str | None = None, assessable_only: bool = False, filler: tuple[str, ...] = retrieval.FILLER) -> DataFrame:
        q = retrieval.parse_query(query, filler)
        if self._index is None:
            self._index = retrieval.bm25f_index(self._fields())
        points = self.kps(grade, domain, None, None, True if assessable_only else None, verifiable_type)
        every = self.located()
        spans = self.t["points"].select(F.col("id").alias("kp_id"), F.explode("review_lesson_ids").alias("lesson_id")).join(self.places().select("lesson_id", F.col("grade").alias("_r")), "lesson_id").groupBy("kp_id").agg(F.max("_r").alias("_last"))
        every = every.join(spans, "kp_id", "left").withColumn("last_grade", F.greatest("grade", F.coalesce("_last", "grade")))
        if q.scope and not q.has_content:
            ok = F.col("domain").isin(*q.domains) if q.domains else F.lit(True)
            wanted = lambda v, t: F.lit(v).cast(t)
            total = retrieval.scope_score(F.col("grade"), F.col("semester"), wanted(q.grades[0] if q.grades else None, "int"), wanted(q.semester, "string"), ok, F.coalesce("is_assessable", F.lit(False)) & ~F.col("name").contains("总复习"))
            scored = every.withColumn("score", total)
        else:
            clauses = [(0, i, w, c) for i, (c, w) in enumerate(zip(q.clauses or [query], q.weights or [1.0], strict=False))]
            rows = self.spark.createDataFrame(clauses, "query_id int, clause int, weight double, text string").withColumn("tokens", retrieval.tokens(F.col("text")))
            lex = retrieval.lexical_scores(rows, self._index).select(F.col("doc_id").alias("kp_id"), F.col("score").alias("lexical"))
            scored = every.join(lex, "kp_id", "left").fillna(0.0, ["lexical"])
            if self._embed is not None:
                dense = self._embed(rows, every).select(F.col("doc_id").alias("kp_id"), "dense")
                scored = retrieval.fused(scored.join(dense, "kp_id", "left").fillna(0.0, ["dense"]).withColumn("query_id", F.lit(0))).withColumn("lexical", F.col("fused"))
            prior: Column = F.when(F.col("domain").isin(*q.domains), retrieval.DOMAIN_BOOST).otherwise(1.0) if q.domains else F.lit(1.0)
            if q.grades:
                factors = [retrieval.grade_prior(F.col("grade"), F.col("last_grade"), F.lit(g), F.col("semester") == F.lit(q.semester) if q.semester else F.lit(False), F.lit(i == 0)) for i, g in enumerate(q.grades)]
                prior = prior * (F.greatest(*factors) if len(factors) > 1 else factors[0])
            scored = scored.withColumn("score", F.col("lexical") * prior)
        kept = scored.join(points.select("kp_id"), "kp_id", "left_semi").withColumnRenamed("kp_id", "doc_id")
        out = retrieval.diversified(kept, k) if q.scope else retrieval.ranked(kept, k)
        return out.select("place", F.col("doc_id").alias("kp_id"), "score", "name", "domain", "grade", "semester", "unit_title", F.col("introduced_in").alias("lesson_id"), "lesson_title").orderBy("place")

    # ---- exercises

    def instantiate_many(self, card_id: str, n: int = 1, seed0: int = 0, unique: bool = True, lesson_id: str | None = None, only_in_bounds: bool = False, accept_borderline: bool = False, max_tries: int = 50) -> DataFrame:
        """Up to n exercises of consecutive seeds; with ``unique`` the first seed of each set of parameters. At most max(60, 20 n) seeds are tried.

        With a lesson each has its ``verdict`` against the lesson's boundary; ``only_in_bounds`` takes
        the first of ``max_tries`` draws of a seed that is ``in`` (or borderline, if accepted).
        """
        made = self._exercises(card_id, (max(60, 20 * n) if unique else n), seed0, lesson_id, only_in_bounds, accept_borderline, max_tries).where("error IS NULL")
        if unique:
            keep = [c for c in made.columns if c not in ("card_id", "params", "seed", "error")]
            made = made.groupBy("card_id", "params").agg(F.min("seed").alias("seed"), *(F.min_by(c, "seed").alias(c) for c in keep))
        return made.orderBy("seed").limit(n)

    def _exercises(self, card_id: str, seeds: int, seed0: int, lesson_id: str | None, only_in_bounds: bool, accept_borderline: bool, max_tries: int) -> DataFrame:
        from skeinworks.functions.generate import instantiate_many, instantiate_within

        if only_in_bounds and lesson_id is None:
            raise ValueError("only_in_bounds needs a lesson")
        card = self.archetype(card_id)
        spec = json.dumps({"id": card.id, "template": card.template, "slots": json.loads(card.slots or "{}"), "constraints": list(card.constraints or []), "solver": card.solver, "answer": card.answer})
        rows = self.spark.range(seed0, seed0 + seeds).select(F.lit(card_id).alias("card_id"), F.lit(spec).alias("card"), F.col("id").alias("seed"))
        if lesson_id is None:
            return instantiate_many(rows)
        self.lesson_position(lesson_id)  # an unknown lesson is an error
        bounds = lattice.snapshots(self.t["facts"], self.places().select("lesson_id", "position", "unit_id")).where(F.col("lesson_id") == lesson_id)
        return instantiate_within(rows.withColumn("lesson_id", F.lit(lesson_id)), bounds, only_in_bounds, accept_borderline, max_tries)

    def instantiate(self, card_id: str, seed: int = 0, lesson_id: str | None = None, only_in_bounds: bool = False, accept_borderline: bool = False, max_tries: int = 50) -> Row:
        """The exercise of one seed; NoInBounds if no draw stays within the lesson's boundary, Unsatisfiable if none meets the constraints."""
        from skeinworks.functions.generate import NoInBounds, Unsatisfiable

        row = self._exercises(card_id, 1, seed, lesson_id, only_in_bounds, accept_borderline, max_tries).first()
        if row.error is not None:
            raise {"NoInBounds": NoInBounds, "Unsatisfiable": Unsatisfiable}.get(row.error, ValueError)(f"{card_id}, seed {seed}: {row.error}")
        return row
