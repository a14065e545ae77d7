"""Evaluation statistics on labelled tables: precision and recall, agreement, clusters, rankings, sampling, label merging."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skeinworks.functions.scalars import f1, wilson
from skeinworks.session import materialise


def precision_recall(rows: DataFrame, gold: str, pred: str, group: list[str] | None = None) -> DataFrame:
    """``tp, fp, fn, precision, recall, f1`` of boolean columns; null counts as false."""
    g, p = F.coalesce(gold, F.lit(False)), F.coalesce(pred, F.lit(False))
    counts = rows.groupBy(*(group or [])).agg(F.count_if(g & p).alias("tp"), F.count_if(~g & p).alias("fp"), F.count_if(g & ~p).alias("fn"))
    return _prf(counts)


def _prf(counts: DataFrame) -> DataFrame:
    out = counts.withColumn("precision", wilson(F.col("tp"), F.col("tp") + F.col("fp"))["p"]).withColumn("recall", wilson(F.col("tp"), F.col("tp") + F.col("fn"))["p"])
    return out.withColumn("f1", f1(F.col("precision"), F.col("recall")))


def per_class(rows: DataFrame, gold: str, pred: str) -> DataFrame:
    """One against the rest: a row for each label that occurs on either side."""
    sides = F.when(F.col(gold).eqNullSafe(F.col(pred)), F.array(F.struct(F.col(gold).alias("label"), F.lit("tp").alias("k")))).otherwise(F.array(F.struct(F.col(gold).alias("label"), F.lit("fn").alias("k")), F.struct(F.col(pred).alias("label"), F.lit("fp").alias("k"))))
    each = rows.select(F.explode(sides).alias("x")).select("x.label", "x.k").where("label IS NOT NULL")
    return _prf(each.groupBy("label").agg(*(F.count_if(F.col("k") == k).alias(k) for k in ("tp", "fp", "fn"))))


def cohen_kappa(rows: DataFrame, a: str, b: str) -> DataFrame:
    """``n, observed, expected, kappa``: 1 if agreement is certain by chance; null without rows."""
    both = rows.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    total = both.agg(F.count(F.lit(1)).alias("n"), F.avg((F.col(a) == F.col(b)).cast("int")).alias("po"))
    ma, mb = both.groupBy(F.col(a).alias("l")).agg(F.count(F.lit(1)).alias("x")), both.groupBy(F.col(b).alias("l")).agg(F.count(F.lit(1)).alias("y"))
    chance = ma.join(mb, "l").agg(F.sum(F.col("x") * F.col("y")).alias("s"))
    pe = F.coalesce("s", F.lit(0)) / (F.col("n") * F.col("n"))
    out = total.crossJoin(chance).withColumn("pe", F.when(F.col("n") > 0, pe))
    return out.select("n", F.round("po", 4).alias("observed"), F.round("pe", 4).alias("expected"), F.when(F.col("pe") == 1, 1.0).otherwise(F.round((F.col("po") - F.col("pe")) / (1 - F.col("pe")), 4)).alias("kappa"))


def krippendorff_alpha(ratings: DataFrame, unit: str, label: str) -> DataFrame:
    """Nominal alpha of ``unit, label`` ratings: units with two ratings or more; 1 if nothing could disagree.

    Counts by unit and label stand for the pairs within a unit, so nothing is joined with itself.
    """
    cells = ratings.where(F.col(label).isNotNull()).groupBy(unit, label).agg(F.count(F.lit(1)).alias("c"))
    units = cells.groupBy(unit).agg(F.sum("c").alias("m")).where("m >= 2")
    cells = cells.join(units, unit)
    same = cells.groupBy().agg(F.sum(F.col("c") * (F.col("c") - 1) / (F.col("m") - 1)).alias("agree"), F.sum("c").alias("n"))
    marginals = cells.groupBy(label).agg(F.sum("c").alias("nl")).agg(F.sum(F.col("nl") * (F.col("nl") - 1)).alias("chance"))
    out = same.crossJoin(marginals)
    observed, expected = 1 - F.col("agree") / F.col("n"), 1 - F.col("chance") / (F.col("n") * (F.col("n") - 1))
    return out.select("n", F.when(expected == 0, 1.0).otherwise(F.round(1 - observed / expected, 4)).alias("alpha"))


def bcubed(rows: DataFrame, item: str, gold: str, pred: str) -> DataFrame:
    """Mean over items of the share of its predicted (gold) cluster that is in both: sizes and overlaps are counts, no pairs."""
    both = rows.groupBy(gold, pred).agg(F.count(F.lit(1)).alias("_o"))
    g = both.groupBy(gold).agg(F.sum("_o").alias("_g"))
    p = both.groupBy(pred).agg(F.sum("_o").alias("_p"))
    total = both.join(g, gold).join(p, pred).agg(F.sum(F.col("_o") * F.col("_o") / F.col("_p")).alias("sp"), F.sum(F.col("_o") * F.col("_o") / F.col("_g")).alias("sr"), F.sum("_o").alias("n"))
    out = total.select("n", F.round(F.col("sp") / F.col("n"), 4).alias("precision"), F.round(F.col("sr") / F.col("n"), 4).alias("recall"))
    return out.withColumn("f1", f1(F.col("precision"), F.col("recall")))


def ranking_scores(ranks: DataFrame, core: DataFrame, depth: int = 50) -> DataFrame:
    """Per query: recall at 5 and 10 (capped by what fits), hit at 5, reciprocal rank up to ``depth``.

    ``ranks``: ``query_id, doc_id, place``; ``core``: ``query_id, doc_id``. Queries without core documents are left out.
    """
    size = core.groupBy("query_id").agg(F.countDistinct("doc_id").alias("n"))
    hits = core.distinct().join(ranks, ["query_id", "doc_id"]).groupBy("query_id").agg(F.count_if(F.col("place") <= 5).alias("h5"), F.count_if(F.col("place") <= 10).alias("h10"), F.min(F.when(F.col("place") <= depth, F.col("place"))).alias("first"))
    out = size.join(hits, "query_id", "left").fillna(0, ["h5", "h10"])
    return out.select("query_id", *(F.round(F.col(f"h{k}") / F.least(F.col("n"), F.lit(k)), 4).alias(f"recall{k}") for k in (5, 10)), (F.col("h5") > 0).cast("int").alias("hit5"), F.round(F.coalesce(1 / F.col("first"), F.lit(0.0)), 4).alias("mrr"))


def bootstrap_interval(values: DataFrame, column: str, resamples: int = 10_000, seed: int = 0) -> DataFrame:
    """``mean, lo, hi`` of percentile bootstrap over all values that are not null; the draws are seeded.

    A resample of n rows is a multinomial draw of n over the distinct values. These are dealt out by
    hash: one draw tells how many rows fall to each share of them (the same in every task), and a task
    draws these from its own values, so any number of values is drawn where it is. What is merged is a
    sum for each resample.
    """
    n_parts = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = values.select(F.col(column).cast("double").alias("value")).where("value IS NOT NULL").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    counts = materialise(counts.withColumn("part", F.pmod(F.xxhash64("value"), F.lit(n_parts)).cast("int")), "values")
    sizes = sorted((r.part, r.n) for r in counts.groupBy("part").agg(F.sum("n").alias("n")).collect())  # a row for each share
    place, rows = {part: i for i, (part, _) in enumerate(sizes)}, np.array([n for _, n in sizes], np.int64)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, part = pdf.sort_values("value"), int(pdf["part"].iloc[0])
        xs, n = pdf["value"].to_numpy(float), pdf["n"].to_numpy(np.int64)
        dealt, own = np.random.default_rng([seed, n_parts]), np.random.default_rng([seed, n_parts, part + 1])
        share, inside = rows / rows.sum(), n / n.sum()
        sums = [float(own.multinomial(dealt.multinomial(rows.sum(), share)[place[part]], inside) @ xs) for _ in range(resamples)]
        return pd.DataFrame({"resample": np.arange(-1, resamples), "total": [float(n @ xs), *sums]})

    drawn = counts.groupBy("part").applyInPandas(run, "resample int, total double").groupBy("resample").agg((F.sum("total") / F.lit(int(rows.sum()))).alias("mean"))
    ordered = F.array_sort(F.collect_list(F.when(F.col("resample") >= 0, F.col("mean"))))  # one row, as long as there are resamples
    at = lambda q: F.round(F.element_at("means", int(q * resamples) + 1), 4)
    found = drawn.agg(F.round(F.max(F.when(F.col("resample") < 0, F.col("mean"))), 4).alias("mean"), ordered.alias("means")).where("mean IS NOT NULL")
    return found.select("mean", at(0.025).alias("lo"), at(0.975).alias("hi"))


def three_views(rows: DataFrame, gold: str, verdict: str) -> DataFrame:
    """Precision and recall of ``out`` with borderline taken as out (strict), as in (lenient), and left out (decided)."""
    views = F.explode(F.array(*(F.lit(v) for v in ("strict", "lenient", "decided")))).alias("view")
    each = rows.select(gold, verdict, views).where(~((F.col("view") == "decided") & (F.col(verdict) == "borderline")))
    pred = (F.col(verdict) == "out") | ((F.col("view") == "strict") & (F.col(verdict) == "borderline"))
    return precision_recall(each.withColumn("_p", pred), gold, "_p", ["view"])


def merged_labels(first: DataFrame, second: DataFrame, arbiter: DataFrame, least: float = 0.7) -> DataFrame:
    """``item_id, label, status`` of two annotators (``item_id, label``) and an arbiter (``item_id, label, confidence``).

    Equal labels are consensus; else, also where an annotator failed, the arbiter decides
    (``arbitrated``), or a human if its confidence is low or missing (``queue``); an item that the
    arbiter failed on as well is ``failed``.
    """
    both = first.select("item_id", F.col("label").alias("x")).join(second.select("item_id", F.col("label").alias("y")), "item_id", "full").join(arbiter.select("item_id", F.col("label").alias("z"), "confidence"), "item_id", "left")
    status = F.when(F.col("x") == F.col("y"), "consensus").when(F.col("z").isNull(), "failed").when(F.coalesce("confidence", F.lit(0)) < least, "queue").otherwise("arbitrated")
    return both.withColumn("status", status).select("item_id", F.when(F.col("status") == "consensus", F.col("x")).when(F.col("status").isin("queue", "arbitrated"), F.col("z")).alias("label"), "status")


def screened_pairs(picks: DataFrame, strong: str = "same") -> DataFrame:
    """First step of anchor labels: what any annotator picked, as ``anchor, candidate, a, b, screened_by, relation``.

    ``picks``: ``anchor, annotator, candidate, relation``. ``a, b`` is the pair in order,
    ``screened_by`` the sorted annotators, ``relation`` ``strong`` if one of them says so, else the
    least. Nothing depends on blocking.
    """
    known = picks.where("anchor IS NOT NULL AND candidate IS NOT NULL AND anchor <> candidate")
    least = F.coalesce(F.max(F.when(F.col("relation") == strong, F.lit(strong))), F.min("relation"))
    out = known.groupBy("anchor", "candidate").agg(F.array_sort(F.collect_set("annotator")).alias("screened_by"), least.alias("relation"))
    return out.select("anchor", "candidate", F.least("anchor", "candidate").alias("a"), F.greatest("anchor", "candidate").alias("b"), "screened_by", "relation")


def screening_overlap(screened: DataFrame, annotators: int = 2) -> DataFrame:
    """``n_pairs, overlap``: the share of screened pairs that all annotators picked; null without pairs."""
    every = (F.size("screened_by") == annotators).cast("int")
    return screened.agg(F.count(F.lit(1)).alias("n_pairs"), F.round(F.avg(every), 4).alias("overlap"))


def anchor_labels(anchors: DataFrame, screened: DataFrame, labels: DataFrame, classes: list[str]) -> DataFrame:
    """Second step: for each ``anchor`` the sorted candidates of each class, and ``n_decided``.

    ``labels``: ``a, b, label`` of the pairs (``merged_labels`` with the pair as its item). Anchors
    that nothing was picked for have empty lists; pairs without a label count as decided in no class.
    """
    decided = screened.select("anchor", "candidate", "a", "b").join(labels.select("a", "b", "label"), ["a", "b"], "left")
    lists = [F.array_sort(F.collect_list(F.when(F.col("label") == c, F.col("candidate")))).alias(c) for c in classes]
    own = decided.groupBy("anchor").agg(*lists, F.count("label").alias("n_decided"))
    out = anchors.select("anchor").distinct().join(own, "anchor", "left")
    return out.select("anchor", *(F.coalesce(c, F.array().cast(own.schema[c].dataType)).alias(c) for c in classes), F.coalesce("n_decided", F.lit(0)).alias("n_decided"))


def gold_split(development: DataFrame, demoted: DataFrame, holdout: DataFrame, split: str) -> DataFrame:
    """Gold rows of ``val`` (development and what was a test once, marked ``demoted``), ``test`` (never seen) or ``all``."""
    marked = lambda df, flag: df.withColumn("demoted", F.lit(flag))
    seen = marked(development, False).unionByName(marked(demoted, True))
    parts = {"val": lambda: seen, "test": lambda: marked(holdout, False), "all": lambda: seen.unionByName(marked(holdout, False))}
    if split not in parts:
        raise ValueError(f"split is one of {', '.join(parts)}")
    return parts[split]()


def tiered_labels(base: DataFrame, delta: DataFrame) -> DataFrame:
    """``query_id, doc_id, tier`` after an update: the delta's tier replaces, ``none`` removes, core wins over related of the same source."""
    rank = lambda c: F.when(c == "core", 2).when(c == "related", 1).otherwise(0)
    best = lambda df: df.groupBy("query_id", "doc_id").agg(F.max_by("tier", rank(F.col("tier"))).alias("tier"))
    joined = best(base).withColumnRenamed("tier", "_old").join(best(delta).withColumnRenamed("tier", "_new"), ["query_id", "doc_id"], "full")
    return joined.select("query_id", "doc_id", F.coalesce("_new", "_old").alias("tier")).where("tier <> 'none'")


def stratified(rows: DataFrame, stratum: str, key: str, n: int, seed: int = 0) -> DataFrame:
    """At most n rows of each stratum, by the md5 of seed and key: the same on every run and engine."""
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return rows.withColumn("_h", order).withColumn("_n", F.row_number().over(Window.partitionBy(stratum).orderBy("_h", key))).where(F.col("_n") <= n).drop("_h", "_n")


def failure_examples(rows: DataFrame, category: str, key: str, n: int = 5) -> DataFrame:
    """Categories by frequency, with their first n keys joined by commas."""
    numbered = rows.where(F.col(category).isNotNull()).withColumn("_n", F.row_number().over(Window.partitionBy(category).orderBy(key)))
    return numbered.groupBy(category).agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("_n") <= n, F.col(key)))).cast("array<string>"), ",").alias("examples"))


def gates(metrics: DataFrame) -> DataFrame:
    """``passed`` of ``value, threshold, direction`` (``min`` or ``max``); null without a threshold."""
    return metrics.withColumn("passed", F.when(F.col("threshold").isNull(), None).when(F.col("direction") == "max", F.col("value") <= F.col("threshold")).otherwise(F.col("value") >= F.col("threshold")))


def condition_label(*cases: tuple[Column, str], other: str) -> Column:
    """A ladder of conditions: the first that holds names the category."""
    out = None
    for test, name in cases:
        out = F.when(test, name) if out is None else out.when(test, name)
    return F.lit(other) if out is None else out.otherwise(other)


def pair_scores(gold: DataFrame, pred: DataFrame) -> DataFrame:
    """``tp, fp, fn, precision, recall, f1`` of predicted pairs ``a, b`` against gold ones."""
    both = gold.select("a", "b").distinct().withColumn("g", F.lit(True)).join(pred.select("a", "b").distinct().withColumn("p", F.lit(True)), ["a", "b"], "full")
    return precision_recall(both, "g", "p")


def closure_scores(gold: DataFrame, pred: DataFrame) -> DataFrame:
    """Scores of predicted edges ``src, dst`` against gold pairs, both with everything that follows from them."""
    from skeinworks.operators.graph import closure

    named = lambda df: closure(df).select(F.col("src").alias("a"), F.col("dst").alias("b"))
    return pair_scores(named(gold), named(pred))


def candidate_recall(gold: DataFrame, candidates: DataFrame) -> DataFrame:
    """``k, n, p, lo, hi``: the share of gold pairs ``a, b`` that blocking keeps, in whichever order."""
    low = lambda df: df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    hit = low(gold).join(low(candidates).withColumn("_c", F.lit(1)), ["a", "b"], "left")
    counts = hit.agg(F.count("_c").alias("k"), F.count(F.lit(1)).alias("n"))
    return counts.withColumn("w", wilson(F.col("k"), F.col("n"))).select("k", "n", "w.*")
