"""Capability boundaries: what has been introduced up to each place of the sequence, and items held against it.

A *fact* is ``dimension, op, token, num, position``: a token of a set dimension (``token`` set) or a
bound of a maximum dimension (``num`` set) that is granted at a position. Everything is a minimum of
positions, so folds are plain aggregations and any order of facts gives the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skeinworks.functions.numbers import FRACTION_IMPLIES, FRACTION_TYPES, OPERATION_TAGS, operation_closure
from skeinworks.operators.sequence import running_max
from skeinworks.session import materialise

KEY = ["dimension", "op", "token"]
#: Rows of a table of tokens that is broadcast at most; a larger one is shuffled.
LISTED = 100_000


def closed_fractions(facts: DataFrame) -> DataFrame:
    """Fraction types with those they imply, as folding adds them. The implication table is a constant of ten rows."""
    rows = [(t, i) for t, implied in FRACTION_IMPLIES.items() for i in [t, *implied]]
    table = facts.sparkSession.createDataFrame([*rows, ("几分之一", "几分之一")], "token string, implied string")
    fractions = facts.where("dimension = 'fraction_types'").join(F.broadcast(table), "token", "left").withColumn("token", F.coalesce("implied", "token")).drop("implied")
    return facts.where("dimension <> 'fraction_types'").unionByName(fractions.select(facts.columns))


def introduced(facts: DataFrame) -> DataFrame:
    """First position of each token of the set dimensions."""
    return facts.where("token IS NOT NULL").groupBy(*KEY).agg(F.min("position").alias("position"))


def additions(facts: DataFrame) -> DataFrame:
    """Delta encoding: at each position only what is new there, tokens sorted and joined by commas."""
    return introduced(facts).groupBy("position", "dimension", "op").agg(F.array_join(F.array_sort(F.collect_set("token")), ",").alias("added"))


def rebuilt(deltas: DataFrame) -> DataFrame:
    """Decodes deltas (``position, dimension, op, added``): at each position of a dimension, all tokens so far.

    A token is added once, so a dimension has as many deltas as tokens at most: its vocabulary bounds
    the window, not the number of lessons.
    """
    w = Window.partitionBy("dimension", "op").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    tokens = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.split("added", ",")).over(w))))
    return deltas.select("position", "dimension", "op", F.array_join(tokens, ",").alias("allowed"))


def boundary_at(facts: DataFrame, positions: DataFrame) -> DataFrame:
    """Tokens allowed at each given position: ``position, dimension, op, token``.

    Positions are dealt out by range. A token goes once to the range it is introduced in and to each
    later one (there are as many ranges as shuffle partitions at most), where it meets the positions
    of that range alone.
    """
    n = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = materialise(positions.select(F.col("position").cast("long").alias("at")).where("at IS NOT NULL").distinct().repartitionByRange(n, "at").withColumn("_range", F.spark_partition_id()), "positions")
    ends = sorted((r.last, r._range) for r in at.groupBy("_range").agg(F.max("at").alias("last")).collect())  # a row for each range
    if not ends:
        return introduced(facts).select(F.col("position").cast("long").alias("position"), *KEY).limit(0)
    numbered = F.array(*(F.struct(F.lit(last).alias("last"), F.lit(r).alias("r")) for last, r in ends))
    tokens = introduced(facts).withColumn("_range", F.explode(F.transform(F.filter(numbered, lambda e: e["last"] >= F.col("position")), lambda e: e["r"])))
    return at.join(tokens, "_range").where(F.col("position") <= F.col("at")).select(F.col("at").alias("position"), *KEY)


def snapshots(facts: DataFrame, lessons: DataFrame) -> DataFrame:
    """The boundary of each lesson (``lesson_id, position, unit_id``) in a few numbers, at the lesson (``now``) and at the end of its unit:
    ``lesson_id``, the largest ``integer`` and ``decimal`` places, and ``fractions`` as bits in the order of FRACTION_TYPES.

    Lessons of a unit follow each other, so what is introduced by the unit's last lesson and not yet is introduced in the unit.
    """
    facts = closed_fractions(facts)
    dimensions = {"integer_domain": "integer", "decimal_places": "decimal"}
    ends = lessons.groupBy("unit_id").agg(F.max("position").alias("_end"))
    at = materialise(lessons.join(ends, "unit_id").select("lesson_id", F.col("position").cast("long").alias("now"), F.col("_end").cast("long").alias("unit")), "lessons")
    asked = at.select(F.explode(F.array("now", "unit")).alias("position")).distinct()
    asked = asked.select(F.explode(F.array(*map(F.lit, dimensions))).alias("dimension"), "position", F.lit(None).cast("long").alias("num"), F.lit(1).alias("kind"))
    named = facts.where(F.col("num").isNotNull() & F.col("dimension").isin(*dimensions)).select("dimension", F.col("position").cast("long").alias("position"), F.col("num").cast("long").alias("num"), F.lit(0).alias("kind"))
    reached = running_max(named.unionByName(asked), ["position", "kind"], "num", ["dimension"], "reached").where("kind = 1")
    first = introduced(facts).where("dimension = 'fraction_types'").agg(*(F.min(F.when(F.col("token") == t, F.col("position"))).alias(f"_f{i}") for i, t in enumerate(FRACTION_TYPES)))
    bits = sum((F.when(F.col(f"_f{i}") <= F.col("position"), F.lit(1 << i)).otherwise(0) for i in range(len(FRACTION_TYPES))), F.lit(0)).cast("long")
    found = reached.groupBy("position").agg(*(F.max(F.when(F.col("dimension") == d, F.col("reached"))).alias(n) for d, n in dimensions.items())).crossJoin(F.broadcast(first))  # one row
    found = materialise(found.select("position", "integer", "decimal", bits.alias("fractions")), "snapshots")
    for when in ("now", "unit"):
        at = at.join(found.select(F.col("position").alias(when), *(F.col(c).alias(f"{c}_{when}") for c in ("integer", "decimal", "fractions"))), when)
    return at.drop("now", "unit")


def steps(facts: DataFrame) -> DataFrame:
    """Where the bound of each maximum dimension rises: ``dimension, num, position``."""
    at = facts.where("num IS NOT NULL").groupBy("dimension", "position").agg(F.max("num").alias("num"))
    return running_max(at, "position", "num", ["dimension"], "_before", before=True).where("_before IS NULL OR num > _before").drop("_before")


def first_reaching(needs: DataFrame, facts: DataFrame) -> DataFrame:
    """``dimension, need`` with the first position whose bound is at least ``need`` (null if none is).

    From the largest number down, the least position so far: needs and facts are one sequence, and no
    need meets more than one row.
    """
    granted = facts.where("num IS NOT NULL").groupBy("dimension", "num").agg(F.min("position").alias("position"))
    asked = needs.where("need IS NOT NULL").select("dimension", F.col("need").cast("long").alias("num"), F.lit(None).cast("long").alias("position")).distinct()
    rows = granted.select("dimension", F.col("num").cast("long").alias("num"), F.col("position").cast("long").alias("position"), F.lit(0).alias("_asked")).unionByName(asked.withColumn("_asked", F.lit(1)))
    folded = running_max(rows.withColumn("_down", -F.col("num")).withColumn("_late", -F.col("position")), ["_down", "_asked"], "_late", ["dimension"], "_first")
    return folded.where("_asked = 1").select("dimension", F.col("num").alias("need"), (-F.col("_first")).alias("position"))


def bound_along(facts: DataFrame, dimension: str) -> DataFrame:
    """The running maximum of one dimension at each of its positions."""
    return running_max(facts.where(F.col("dimension") == dimension).groupBy("position").agg(F.max("num").alias("num")), "position", "num")


def boundary_leq(a: Column, b: Column, maxima: list[str], sets: list[str]) -> Column:
    """Product order of two boundary structs: maxima with null as 0, sets by inclusion with null as empty."""
    ok = F.lit(True)
    for m in maxima:
        ok = ok & (F.coalesce(a[m], F.lit(0)) <= F.coalesce(b[m], F.lit(0)))
    for s in sets:
        empty = F.array().cast("array<string>")
        ok = ok & (F.size(F.array_except(F.coalesce(a[s], empty), F.coalesce(b[s], empty))) == 0)
    return ok


def operation_allowances(spark: SparkSession) -> DataFrame:
    """``op, token, implied``: what each operand form allows, itself included."""
    rows = [(op, t, i) for op, tags in OPERATION_TAGS.items() for t in tags for i in sorted(operation_closure(op, {t}))]
    return spark.createDataFrame(rows, "op string, token string, implied string")


def allowed_from(facts: DataFrame) -> DataFrame:
    """First position at which each token is allowed: operand forms also through forms that imply them."""
    first = introduced(facts)
    ops = first.where("dimension = 'operation_forms'").join(F.broadcast(operation_allowances(facts.sparkSession)), ["op", "token"], "left")
    ops = ops.groupBy("dimension", "op", F.coalesce("implied", "token").alias("token")).agg(F.min("position").alias("position"))
    return first.where("dimension <> 'operation_forms'").select(*KEY, "position").unionByName(ops.select(*KEY, "position"))


def check_items(needs: DataFrame, facts: DataFrame, lessons: DataFrame, known_terms: DataFrame | None = None, ignored: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Holds items against the boundary of their lesson: (violations, reports).

    ``needs``: ``item_id, lesson_id, dimension, op, token, need`` (token or need set; dimension
    ``carry_or_borrow`` has neither). ``lessons``: ``lesson_id, position, unit_id``. ``known_terms``:
    ``dimension, token`` that count as violations even if never introduced; other tokens never
    introduced are unknown in open dimensions. ``ignored``: ``dimension, token`` that are neither.

    violations: ``item_id, lesson_id, dimension, op, value, introduced`` (a position or null). reports:
    ``item_id, lesson_id, verdict, n_violations, n_unknown``: ``in``; ``borderline`` if all violations
    are introduced later in the lesson's own unit; else ``out``.
    """
    facts = materialise(closed_fractions(facts), "facts")
    # What is introduced where stays in small tables of tokens and numbers, so that no join of needs meets a hot position.
    unit = lessons.select(F.col("position").alias("_at"), F.col("unit_id").alias("intro_unit"))
    at = needs.join(lessons.select("lesson_id", F.col("position").alias("here"), "unit_id"), "lesson_id")
    if ignored is not None:
        at = at.join(ignored.select("dimension", "token").distinct(), ["dimension", "token"], "left_anti")
    at = materialise(at.select("item_id", "lesson_id", "here", "unit_id", *KEY, "need"), "needs")
    base = ["item_id", "lesson_id", "here", "unit_id"]
    first = introduced(facts).select(*KEY, F.col("position").alias("raw")).join(unit, F.col("raw") == F.col("_at"), "left").drop("_at")
    # One row for each token: when it was named, and when it is allowed, also through others.
    known = materialise(first.unionByName(allowed_from(facts).select(*KEY, F.col("position").alias("allowed")), allowMissingColumns=True).groupBy(*KEY).agg(F.min("raw").alias("raw"), F.min("allowed").alias("allowed"), F.min("intro_unit").alias("intro_unit")), "tokens")
    known = F.broadcast(known) if known.count() <= LISTED else known
    # Maxima.
    reach = first_reaching(at.select("dimension", "need"), facts).withColumnRenamed("position", "allowed").join(unit, F.col("allowed") == F.col("_at"), "left").drop("_at")
    reach = materialise(reach, "reach", few=True)
    reach = F.broadcast(reach) if reach.count() <= LISTED else reach  # few numbers are asked for by many needs
    numbers = at.where("need > 0").groupBy(*base, "dimension").agg(F.max("need").alias("need")).join(reach, ["dimension", "need"], "left").where("allowed IS NULL OR allowed > here")
    numbers = numbers.select(*base, "dimension", F.lit(None).cast("string").alias("op"), F.col("need").cast("string").alias("value"), F.col("allowed").alias("introduced"), "intro_unit", F.lit(False).alias("doubt"))
    # Tokens: one not allowed yet is a violation if it is known at all or of a closed vocabulary, else a doubt.
    said = at.where("token IS NOT NULL AND token <> '分数'")
    tokens = said.join(known, [said["dimension"] == known["dimension"], said["op"].eqNullSafe(known["op"]), said["token"] == known["token"]], "left").select(*base, *(said[c] for c in KEY), "raw", "allowed", "intro_unit")
    closed = F.col("dimension").isin("fraction_types", "operation_forms", "units_of_measure") | F.col("raw").isNotNull() | F.col("allowed").isNotNull()
    if known_terms is not None:
        marked = known_terms.select("dimension", "token", F.lit(True).alias("_marked")).distinct()
        tokens = tokens.join(marked, ["dimension", "token"], "left")
        closed = closed | F.coalesce("_marked", F.lit(False))
    missing = tokens.where("allowed IS NULL OR allowed > here").withColumn("doubt", ~closed)
    sets = missing.where("dimension <> 'operation_forms'").select(*base, "dimension", "op", F.col("token").alias("value"), F.col("raw").alias("introduced"), "intro_unit", "doubt")
    forms = missing.where("dimension = 'operation_forms'").groupBy(*base, "dimension", "op").agg(F.array_join(F.array_sort(F.collect_set("token")), "、").alias("value"), F.max("raw").alias("introduced"), F.max_by("intro_unit", "raw").alias("intro_unit")).withColumn("doubt", F.lit(False))
    # Any fraction, and carrying or borrowing, are allowed by the earliest of several tokens (one row).
    which = {"fraction": F.col("dimension") == "fraction_types", "carry": (F.col("dimension") == "operation_forms") & F.col("token").isin("进位", "退位")}
    any_of = first.agg(*(F.min(F.when(w, F.struct("raw", "intro_unit"))).alias(n) for n, w in which.items()))
    special = at.where("token = '分数' OR dimension = 'carry_or_borrow'").crossJoin(F.broadcast(any_of))
    special = special.withColumn("_of", F.when(F.col("token") == "分数", F.col("fraction")).otherwise(F.col("carry"))).withColumn("introduced", F.col("_of.raw")).where("introduced IS NULL OR introduced > here")
    special = special.select(*base, "dimension", F.lit(None).cast("string").alias("op"), F.coalesce("token", F.lit("进位/退位")).alias("value"), "introduced", F.col("_of.intro_unit").alias("intro_unit"), F.lit(False).alias("doubt"))
    found = numbers.unionByName(sets).unionByName(forms).unionByName(special)
    found = materialise(found.withColumn("soft", F.coalesce((F.col("introduced") > F.col("here")) & (F.col("intro_unit") == F.col("unit_id")), F.lit(False))), "found")
    items = needs.select("item_id", "lesson_id").join(lessons.select("lesson_id"), "lesson_id", "left_semi").select("item_id", "lesson_id", F.lit(None).cast("boolean").alias("doubt"), F.lit(None).cast("boolean").alias("soft"))
    judged = items.unionByName(found.select("item_id", "lesson_id", "doubt", "soft")).groupBy("item_id", "lesson_id").agg(F.count_if(~F.col("doubt")).alias("n_violations"), F.count_if("doubt").alias("n_unknown"), F.every(F.col("doubt") | F.col("soft")).alias("soft"))
    verdict = F.when(F.col("n_violations") == 0, "in").when(F.col("soft"), "borderline").otherwise("out")
    return found.where("NOT doubt").select("item_id", "lesson_id", "dimension", "op", "value", "introduced"), judged.select("item_id", "lesson_id", verdict.alias("verdict"), "n_violations", "n_unknown")


def merged_grants(grants: DataFrame, by: str) -> DataFrame:
    """Joins several grants of one owner: the largest bound, the union of tokens."""
    return grants.groupBy(by, "dimension", "op", "token").agg(F.max("num").alias("num"))


def effective_grants(enriched: DataFrame, draft: DataFrame, residual: DataFrame, by: str = "kp_id") -> DataFrame:
    """Enriched grants; a draft where an owner has none; and the residual facts of lessons."""
    missing = draft.join(enriched.select(by).distinct(), by, "left_anti")
    return enriched.unionByName(missing).unionByName(residual)


def needed_grant(dimension: Column, value: Column) -> Column:
    """The bound that would cover a number: itself up to 100, else all numbers of its length."""
    n = value.try_cast("bigint")
    return F.when(dimension == "integer_domain", F.when(n <= 100, n).otherwise((F.pow(F.lit(10), F.length(n.cast("string"))) - 1).cast("bigint"))).when(dimension == "decimal_places", n)


def coverage_pass(items: DataFrame, grants: DataFrame, repair: bool = False) -> DataFrame:
    """Walks lessons in order and holds each item's need against what was granted so far: ``item_id, ok, repaired``.

    ``items``: ``item_id, position, dimension, need``; ``grants``: ``position, dimension, num``. With
    ``repair`` an item's gap is granted at its lesson and counts for all later ones, so in each
    dimension the sequence is a running maximum over grants and earlier needs.
    """
    rows = grants.select("position", "dimension", "num", F.lit(None).cast("string").alias("item_id"), F.lit(0).alias("kind")).unionByName(
        items.select("position", "dimension", F.col("need").alias("num"), "item_id", F.lit(1).alias("kind"))
    )
    counted = F.col("num") if repair else F.when(F.col("kind") == 0, F.col("num"))
    folded = running_max(rows.withColumn("_counted", counted), ["position", "kind", "item_id"], "_counted", ["dimension"], "_before", before=True)
    out = folded.where("kind = 1").withColumn("ok", F.coalesce("_before", F.lit(0)) >= F.col("num"))
    return out.select("item_id", "dimension", "ok", (~F.col("ok") & F.lit(repair)).alias("repaired"))
