"""Grouping exercises into templates: signatures with back-off, envelopes, canonical merges, difficulty."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skeinworks.operators.sequence import quantile_level, standard_scores
from skeinworks.session import materialise, tasks_for


def backoff_groups(rows: DataFrame, base: list[str], levels: list[list[str]], least: int = 2, tasks: int | None = None) -> DataFrame:
    """Adds ``level`` and ``group_key``: the finest level whose group holds ``least`` rows; the last level keeps all.

    ``levels`` name the extra key columns of each level, finest first. Rows settled at a finer level
    leave the coarser counts. Rows are dealt once, by the keys that all counted levels share, among
    ``tasks`` tasks (by their number, if not given), and sorted once, those keys first.
    """
    counted = levels[:-1]
    dims = list(dict.fromkeys(c for extra in counted for c in extra))
    dims.sort(key=lambda c: -sum(c in extra for extra in counted))
    shared = [c for c in dims if all(c in extra for extra in counted)]
    out = rows.repartition(tasks or tasks_for(rows), *base, *shared) if counted else rows
    level, last = F.lit(None).cast("int"), len(levels) - 1
    for n, extra in enumerate(counted):
        alone = F.count(F.when(level.isNull(), 1)).over(Window.partitionBy(*base, *(c for c in dims if c in extra)))
        out = out.withColumn("level", F.when(level.isNull() & (alone >= least), last - n).otherwise(level))
        level = F.col("level")
    key = None
    for n, extra in enumerate(levels):
        text = F.concat_ws("|", *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in (*base, *extra)))
        key = F.when(F.col("level") == last - n, text) if key is None else key.when(F.col("level") == last - n, text)
    return out.withColumn("level", F.coalesce(level, F.lit(0))).withColumn("group_key", key)


def attached_singletons(rows: DataFrame, base: list[str], dims: list[str], item: str, group: str, tasks: int | None = None) -> DataFrame:
    """Gives each singleton group of a base to the sibling group whose members agree in the most dimensions on average.

    Groups with more members win ties, then the smaller name; a group grows as singletons join it, in
    order of item and own name, nulls first; an item that is in several groups stays one row of each.
    Null agrees with null. Agreement is a sum of counts, so of larger groups only the counts by dimension
    and value meet a base's singletons, and a singleton costs as many steps as there are groups and
    dimensions. Rows are dealt among ``tasks`` tasks (by their number, if not given).
    """
    kind = dict(rows.dtypes)
    tasks = tasks or tasks_for(rows)
    values = F.array(*(F.coalesce(F.concat(F.lit("="), F.col(d).cast("string")), F.lit("")) for d in dims))
    held = rows.select(*base, item, group, values.alias("_values")).repartition(tasks, *base, group)
    sized = materialise(held.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*base, group))), "sized")
    # Dealt again, as a table that was read back is in tasks of any size.
    larger = sized.where("_n > 1").select(*base, group, "_n", "_values").repartition(tasks, *base, group)
    counts = larger.select(*base, group, "_n", F.posexplode("_values").alias("_d", "_v")).groupBy(*base, group, "_n", "_d", "_v").agg(F.count(F.lit(1)).alias("_c"))
    single = sized.where("_n = 1").select(*base, group, "_n", F.lit(None).cast("int").alias("_d"), F.lit(None).cast("string").alias("_v"), F.lit(None).cast("long").alias("_c"), item, "_values")
    both = counts.withColumn(item, F.lit(None).cast(kind[item])).withColumn("_values", F.lit(None).cast("array<string>")).unionByName(single)
    # Only bases with a singleton are walked.
    walked = both.repartition(tasks, *base).withColumn("_least", F.min("_n").over(Window.partitionBy(*base))).where("_least = 1")

    def walk(met: pa.Table) -> pa.Table:
        size, seen, own, single = {}, {}, [], []
        for i, g, n, d, v, c, mine in zip(*(met.column(x).to_pylist() for x in (item, group, "_n", "_d", "_v", "_c", "_values")), strict=True):
            if n == 1:
                single.append((i, g, mine))
            else:
                size[g], seen[g, d, v] = n, c
        for i, g, mine in sorted(single, key=lambda r: [(x is not None, x) for x in r[:2]]):
            best = g
            if size:
                best = min(size, key=lambda o: (-sum(seen.get((o, d, v), 0) for d, v in enumerate(mine)) / size[o], -size[o], o is not None, o))
                size[best] += 1
                for d, v in enumerate(mine):
                    seen[best, d, v] = seen.get((best, d, v), 0) + 1
            own.append((i, best))
        return pa.table({c: pa.array([r[n] for r in own], met.schema.field(c).type) for n, c in enumerate((item, group))})

    joined = walked.groupBy(*base).applyInArrow(walk, f"{item} {kind[item]}, {group} {kind[group]}")
    return sized.where("_n > 1").select(item, group).unionByName(joined)


def envelope(rows: DataFrame, by: list[str], ranges: list[str], sets: list[str], flag: str | None = None) -> DataFrame:
    """Observed ranges, sorted sets joined by commas, share of a flag (3 places) and number of rows; nulls are ignored."""
    aggs: list[Column] = [F.count(F.lit(1)).alias("n")]
    for c in ranges:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    aggs += [F.array_join(F.array_sort(F.collect_set(F.col(c).cast("string"))), ",").alias(f"{c}_set") for c in sets]
    if flag:
        aggs.append(F.round(F.avg(F.col(flag).cast("int")), 3).alias(f"{flag}_ratio"))
    return rows.groupBy(*by).agg(*aggs)


def histogram(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """``value:count`` pairs of each group, sorted by value and joined by commas."""
    counts = rows.groupBy(*by, value).agg(F.count(F.lit(1)).alias("c"))
    return counts.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", F.col(value).cast("string"), F.col("c").cast("string")))), ",").alias("histogram"))


def mode_of(rows: DataFrame, by: str, value: str, order: str) -> DataFrame:
    """The most frequent value of each group, ties by first appearance."""
    counts = rows.groupBy(by, value).agg(F.count(F.lit(1)).alias("c"), F.min(order).alias("first"))
    return counts.groupBy(by).agg(F.max_by(value, F.struct("c", -F.col("first"))).alias(value), F.max("c").alias("n"))


def singleton_stats(groups: DataFrame, key: str, floor_key: str) -> DataFrame:
    """``n, singletons, ratio, floor, excess, compression``: the floor is the share that the coarsest key leaves alone."""
    sizes = groups.groupBy(floor_key, key).agg(F.count(F.lit(1)).alias("c"))
    coarse = sizes.groupBy(floor_key).agg(F.sum("c").alias("t"), F.count(F.lit(1)).alias("k"), F.count_if(F.col("c") == 1).alias("s"))
    total = coarse.agg(F.sum("k").alias("n"), F.sum("s").alias("singletons"), F.count_if(F.col("t") == 1).alias("lone"), F.sum("t").alias("items"))
    ratio, floor = F.col("singletons") / F.col("n"), F.col("lone") / F.col("n")
    return total.select("n", "singletons", F.round(ratio, 4).alias("ratio"), F.round(floor, 4).alias("floor"), F.round(ratio - floor, 4).alias("excess"), F.round(F.col("items") / F.col("n"), 3).alias("compression"))


def difficulty(cards: DataFrame, features: list[str], grade: str, levels: int = 5) -> DataFrame:
    """``score`` (sum of z-scores of the features) and ``difficulty`` 1..levels by rank within the grade."""
    return quantile_level(standard_scores(cards, features), [grade], "score", levels, "difficulty")


def stale(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """Rows whose recomputed value differs: ``key, old, new``."""
    both = old.select(key, F.col(value).alias("old")).join(new.select(key, F.col(value).alias("new")), key)
    return both.where(~F.col("old").eqNullSafe(F.col("new")))


def canonical_merge(members: DataFrame, cluster: str = "cluster") -> DataFrame:
    """One record of each cluster of ``cluster, key, position, name, aliases, mastery_rank, assessable``.

    The earliest member (by position, key) names it; aliases are the other names and aliases in order
    of appearance; mastery is the highest; it is assessable if one member is.
    """
    order = F.struct("position", "key", "name", "aliases")
    merged = members.groupBy(cluster).agg(
        F.min_by("key", F.struct("position", "key")).alias("primary_key"),
        F.min_by("name", F.struct("position", "key")).alias("name"),
        F.array_sort(F.collect_list(order)).alias("_all"),
        F.max("mastery_rank").alias("mastery_rank"),
        F.bool_or("assessable").alias("assessable"),
        F.min("position").alias("intro_position"),
        F.count(F.lit(1)).alias("n_members"),
    )
    named = F.flatten(F.transform("_all", lambda m: F.concat(F.array(m["name"]), F.coalesce(m["aliases"], F.array().cast("array<string>")))))
    return merged.withColumn("aliases", F.array_remove(F.array_distinct(named), F.col("name"))).withColumn("review_positions", F.array_remove(F.array_sort(F.array_distinct(F.transform("_all", lambda m: m["position"]))), F.col("intro_position"))).drop("_all")


def distinct_names(rows: DataFrame, name: str, suffix: str, order: list[str]) -> DataFrame:
    """Gives the second and later rows of one name a suffix."""
    n = F.row_number().over(Window.partitionBy(name).orderBy(*order))
    return rows.withColumn(name, F.when(n > 1, F.concat_ws("_", name, suffix)).otherwise(F.col(name)))


def glossary_merge(terms: DataFrame, order: list[str]) -> DataFrame:
    """Joins entries ``term, alias, notation, book`` whose terms are equal without white space: ordered distinct aliases and books, first notation."""
    keyed = terms.withColumn("term", F.regexp_replace("term", r"\s+", "")).where("term <> ''")
    row = F.struct(*order, "alias", "notation", "book")
    grouped = keyed.groupBy("term").agg(F.array_sort(F.collect_list(row)).alias("_r"))
    pick = lambda c: F.array_distinct(F.filter(F.transform("_r", lambda r: r[c]), lambda x: x.isNotNull()))
    return grouped.select("term", F.array_join(pick("alias"), ",").alias("aliases"), F.element_at(F.concat(pick("notation"), F.array(F.lit(None).cast("string"))), 1).alias("notation"), F.array_join(pick("book"), ",").alias("books"))


def best_evidence(judgments: DataFrame) -> DataFrame:
    """Per (narrow, wide) of ``narrow, wide, confidence, judgment_id``: all evidence in order, and the judgment of the highest confidence (first on ties). Self loops go."""
    real = judgments.where("narrow <> wide")
    return real.groupBy("narrow", "wide").agg(
        F.array_join(F.array_sort(F.collect_list("judgment_id")).cast("array<string>"), ",").alias("evidence"), F.min_by("judgment_id", F.struct(-F.col("confidence"), "judgment_id")).alias("judgment_id"), F.max("confidence").alias("confidence")
    )


def final_mapping(items: DataFrame, post: DataFrame, adjudicated: DataFrame, not_applicable: DataFrame, manual: DataFrame, manual_na: DataFrame) -> DataFrame:
    """Status of each item by the first of: covered after repair or by adjudication (ids joined), not applicable, covered by hand, not applicable by hand, uncovered.

    Each source is ``item_id`` (with ``kp_ids`` where it covers).
    """
    out = items.select("item_id")
    for name, df in (("p", post), ("a", adjudicated), ("m", manual)):
        out = out.join(df.select("item_id", F.col("kp_ids").alias(name)), "item_id", "left")
    for name, df in (("n", not_applicable), ("h", manual_na)):
        out = out.join(df.select("item_id").distinct().withColumn(name, F.lit(True)), "item_id", "left")
    empty = F.array().cast("array<string>")
    both = F.array_sort(F.array_distinct(F.concat(F.coalesce("p", empty), F.coalesce("a", empty))))
    status = F.when(F.size(both) > 0, "covered").when(F.col("n"), "not_applicable").when(F.size(F.coalesce("m", empty)) > 0, "covered").when(F.col("h"), "not_applicable").otherwise("uncovered")
    ids = F.when(F.size(both) > 0, both).when((status == "covered"), F.array_sort("m")).otherwise(empty)
    return out.select("item_id", status.alias("status"), F.array_join(ids, ",").alias("kp_ids"))
