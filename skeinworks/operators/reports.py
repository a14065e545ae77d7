"""Reports: counts with totals, coverage tables, histograms, roll-ups of cards and points, facets, set views of lessons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_of(condition: Column) -> Column:
    return F.count_if(condition)


def counts(rows: DataFrame, keys: list[str], **sums: Column) -> DataFrame:
    """``keys..., n`` and named sums by group."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *(F.sum(c).alias(name) for name, c in sums.items()))


def counts_with_totals(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Counts by group with sub-totals from the right and a total, whose keys are null."""
    return rows.rollup(*keys).agg(F.count(F.lit(1)).alias("n"))


def review_stats(rows: DataFrame, kind: str, passed: Column, every: str = "_all") -> DataFrame:
    """``kind, n, passed`` of each kind and of ``every`` one together (rows without a kind count there, too)."""
    return rows.rollup(kind).agg(F.count(F.lit(1)).alias("n"), F.count_if(passed).alias("passed")).select(F.coalesce(kind, F.lit(every)).alias("kind"), "n", "passed")


def coverage_matrix(rows: DataFrame, row: str, column: str, values: dict[str, str]) -> DataFrame:
    """Counts of ``column``'s values (value -> name) for each ``row``, 0 where there are none."""
    return rows.groupBy(row).agg(*(F.count_if(F.col(column) == value).alias(name) for value, name in values.items()))


def numbers_in(text: Column) -> Column:
    """The plain decimals of a text, as decimals with six places."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"([0-9]{1,9}(?:\.[0-9]{1,6})?)"), F.lit(1)), lambda x: x.cast("decimal(30,6)"))


def number_envelope(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys..., n, low, high`` of the numbers in the texts of a context and grade."""
    each = rows.select(*keys, F.explode(numbers_in(F.col(text))).alias("x"))
    return each.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))


def slugs(points: DataFrame, node: str, thread: str, last_part: Column) -> DataFrame:
    """The last part of a point's name; with its thread in front where several points share it."""
    named = points.select(node, thread, last_part.alias("_last"))
    shared = named.groupBy("_last").agg(F.count(F.lit(1)).alias("_n"))
    return named.join(shared, "_last").select(node, F.when(F.col("_n") > 1, F.concat(thread, F.lit("_"), "_last")).otherwise(F.col("_last")).alias("slug"))


def coverage_ratios(refs: DataFrame, point: str, item: str) -> DataFrame:
    """One row: points covered, items, references for each covered point."""
    return refs.agg(F.countDistinct(point).alias("covered"), F.countDistinct(item).alias("items"), F.round(F.count(F.lit(1)) / F.countDistinct(point).cast("double"), 4).alias("compression"))


def crosscheck(rows: DataFrame, by: str, **tests: Column) -> DataFrame:
    """How many rows of each ``by`` pass each named test."""
    return rows.groupBy(by).agg(*(F.count_if(test).alias(name) for name, test in tests.items()))


def point_rollup(cards: DataFrame, point: str, level: str, kind: str, kinds: dict[str, str]) -> DataFrame:
    """Cards, mean level (rounded half up to 2 places) and counts by kind of each point."""
    mean = F.floor(F.avg(level) * 100 + 0.5) / 100
    return cards.groupBy(point).agg(F.count(F.lit(1)).alias("cards"), mean.alias("mean_level"), *(F.count_if(F.col(kind) == k).alias(name) for k, name in kinds.items()))


def first_listed(values: Column, most: int) -> Column:
    return F.array_join(F.slice(F.array_sort(F.collect_list(values)), 1, most), ",")


def additions_by_unit(points: DataFrame, unit: str, node: str, most: int = 6) -> DataFrame:
    """``unit, n_new`` and the ids of the first points introduced there. Only those are gathered."""
    counted = points.groupBy(unit).agg(F.count(F.lit(1)).alias("n_new"))
    place = F.row_number().over(Window.partitionBy(unit).orderBy(node))
    first = points.select(unit, node, place.alias("_n")).where(F.col("_n") <= most).groupBy(unit).agg(F.array_join(F.array_sort(F.collect_list(node)), ",").alias("first_six"))
    return counted.join(first, unit)


def most_frequent(rows: DataFrame, group: str, member: str, most: int = 5) -> DataFrame:
    """``group, members``: the most frequent members, ties to the smaller, joined by commas."""
    each = rows.groupBy(group, member).agg(F.count(F.lit(1)).alias("_c"))
    place = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("_c"), member))
    top = each.withColumn("_n", place).where(F.col("_n") <= most).groupBy(group).agg(F.array_sort(F.collect_list(F.struct("_n", F.col(member).alias("m")))).alias("_m"))
    return top.select(group, F.array_join(F.transform("_m", lambda x: x["m"].cast("string")), ",").alias("members"))


def observations(found: DataFrame, key: str, listed: DataFrame, listed_key: str) -> DataFrame:
    """``id, n`` of everything found or listed; 0 for what is listed only."""
    n = found.groupBy(F.col(key).alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return n.join(listed.select(F.col(listed_key).alias("id")).distinct(), "id", "full").select("id", F.coalesce("n", F.lit(0)).alias("n"))


def item_verdicts(points: DataFrame, item: str, met: Column) -> DataFrame:
    """``covered`` if all points of an item are met, ``not_covered`` if none is, else ``partial``."""
    from skeinworks.functions.scalars import verdict

    return points.groupBy(item).agg(verdict(F.count_if(met), F.count(F.lit(1))).alias("verdict"))


def facets(rows: DataFrame, values: dict[str, list], ranges: dict[str, tuple] | None = None) -> DataFrame:
    """Rows whose columns hold one of the chosen values (no choice: any) and lie in the chosen ranges."""
    for column, chosen in values.items():
        rows = rows.where(F.col(column).isin(*chosen)) if chosen else rows
    for column, (low, high) in (ranges or {}).items():
        rows = rows.where(F.col(column).between(low, high))
    return rows


def matching_share(rows: DataFrame, by: str, text: str, pattern: str) -> DataFrame:
    """``by, hits, n``: in how many texts a pattern occurs."""
    return rows.groupBy(by).agg(F.count_if(F.col(text).rlike(pattern)).alias("hits"), F.count(F.lit(1)).alias("n"))


def unlearned_next(points: DataFrame, position: int, n: int) -> DataFrame:
    """The next ``n`` points after a place of the sequence."""
    return points.where(F.col("position") > position).orderBy("position", "node").limit(n)


def parted_by_lesson(points: DataFrame, at: int) -> DataFrame:
    """``domain, grade, before, after``: points introduced before a place, and from it on."""
    return points.groupBy("domain", "grade").agg(F.count_if(F.col("position") < at).alias("before"), F.count_if(F.col("position") >= at).alias("after"))


def both_ways(edges: DataFrame, reverse: str = "reverse") -> DataFrame:
    """The edges, and each turned round with the type ``reverse``."""
    return edges.select("src", "dst", "type").union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.lit(reverse).alias("type")))


def common(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct keys that both have."""
    return a.select(key).intersect(b.select(key))


def intro_and_practice(refs: DataFrame, points: DataFrame) -> DataFrame:
    """Each lesson's points (``lesson_id, kp_id``): ``intro`` in the lesson that introduces them (``node, lesson_id``), else ``practice``."""
    first = points.select(F.col("node").alias("kp_id"), F.col("lesson_id").alias("_first"))
    return refs.join(first, "kp_id").select("lesson_id", "kp_id", F.when(F.col("_first") == F.col("lesson_id"), "intro").otherwise("practice").alias("part"))


def first_and_last(refs: DataFrame, lessons: DataFrame) -> DataFrame:
    """``kp_id, position, last_position`` of the first and last lesson that holds a point."""
    return refs.join(lessons.select("lesson_id", "position"), "lesson_id").groupBy("kp_id").agg(F.min("position").alias("position"), F.max("position").alias("last_position"))


def review_span(refs: DataFrame, lessons: DataFrame) -> DataFrame:
    """``kp_id, reviews, last_grade``: lessons after the first that hold a point, and the highest grade among all."""
    return refs.join(lessons.select("lesson_id", "grade"), "lesson_id").groupBy("kp_id").agg((F.count(F.lit(1)) - 1).alias("reviews"), F.max("grade").alias("last_grade"))


def occurring_terms(texts: DataFrame, key: str, text: str, terms: DataFrame, term: str) -> DataFrame:
    """``key, term`` for every term (a run of letters, digits and ``_``) that occurs in a text, also inside a longer run.

    Runs are looked up by their first letters as many as the shortest term has, so a text meets the terms
    that begin like a place of it and not all of them.
    """
    width = 3
    known = terms.select(F.col(term).alias("term")).distinct()
    long, short = known.where(F.length("term") >= width), known.where(F.length("term") < width)
    keyed = long.withColumn("_start", F.substring("term", 1, width))
    starts = F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(f"(?s)(?=(.{{{width}}}))"), F.lit(1)))
    places = texts.select(key, F.explode(starts).alias("_start")).join(keyed, "_start").join(texts.select(key, text), key).where(F.col(text).contains(F.col("term")))
    few = texts.join(short, F.col(text).contains(F.col("term")))
    return places.select(key, "term").union(few.select(key, "term")).distinct()
