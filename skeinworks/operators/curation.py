"""Transforms around judgments: decoding, normalising, overlays, reuse, audits and change logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skeinworks.functions.scalars import clamp_confidence, last_segment, verdict
from skeinworks.operators.sequence import dense_position
from skeinworks.session import tasks_of


def codes(points: DataFrame, order: list[str], prefix: str = "K") -> DataFrame:
    """``node, code``: the place in the order as a prefixed number of three digits at least. Ranges are numbered apart."""
    return dense_position(points.select("node", *(c for c in order if c != "node")), order, "_place").select("node", F.format_string(f"{prefix}%03d", "_place").alias("code"))


def decoded(lists: DataFrame, catalogue: DataFrame, key: str, listed: str) -> DataFrame:
    """``key, node`` of lists of codes; unknown codes are dropped, repeated ones count once."""
    each = lists.select(key, F.explode(listed).alias("code"))
    return each.join(catalogue, "code").select(key, "node").distinct()


def judgment_records(raw: DataFrame, task: str) -> DataFrame:
    """Judgments ``id, task, src, dst, answer, confidence, reason``: confidence in [0, 1], reasons cut at 500 characters."""
    return raw.select(
        F.concat_ws(".", F.lit("j"), F.lit(task), F.col("src").cast("string"), F.col("dst").cast("string")).alias("id"),
        F.lit(task).alias("task"), "src", "dst", "answer",
        clamp_confidence(F.col("confidence").cast("string")).alias("confidence"),
        F.substring("reason", 1, 500).alias("reason"),
    )


def discovered(reports: DataFrame, least: float = 0.8) -> DataFrame:
    """Gaps of accepted, confident reports (``report_id, ok, confidence, gaps``), one row each."""
    return reports.where(F.col("ok") & (F.col("confidence") >= least)).select("report_id", F.posexplode("gaps").alias("n", "gap"))


def raw_sources(clues: DataFrame, standards: DataFrame) -> DataFrame:
    """Clues without a nearest point as D001.. and standard items that are not covered as S001..: ``source_id, kind, ref``."""
    def number(df: DataFrame, letter: str, ref: str) -> DataFrame:
        placed = dense_position(df.select(ref), [ref], "_n")
        n = (F.col("_n") + 1).cast("string")
        return placed.select(F.concat(F.lit(letter), F.lpad(n, F.greatest(F.length(n), F.lit(3)), F.lit("0"))).alias("source_id"), F.lit(letter).alias("kind"), F.col(ref).cast("string").alias("ref"))

    return number(clues.where("nearest IS NULL"), "D", "clue_id").unionByName(number(standards.where("status <> 'covered'"), "S", "item_id"))


def with_topic(rows: DataFrame, known: DataFrame, default: str) -> DataFrame:
    """The last segment of ``thread``, and the topic that its (domain, thread) has already, else a default."""
    topic = known.groupBy("domain", "thread").agg(F.min("topic").alias("_topic"))
    return rows.withColumn("thread", F.trim(last_segment(F.col("thread")))).join(topic, ["domain", "thread"], "left").withColumn("topic", F.coalesce("_topic", F.lit(default))).drop("_topic")


def resolved_curation(decisions: DataFrame) -> DataFrame:
    """``source_id, action, target`` with merges into hosts that are not kept turned to keep, and each host's merged sources.

    Returns ``source_id, action, merged``.
    """
    kept = decisions.where("action = 'keep'").select(F.col("source_id").alias("target"), F.lit(True).alias("_host"))
    out = decisions.join(kept, "target", "left")
    action = F.when((F.col("action") == "merge") & F.col("_host").isNull(), "keep").otherwise(F.col("action"))
    out = out.select("source_id", action.alias("action"), "target")
    merged = out.where("action = 'merge'").groupBy(F.col("target").alias("source_id")).agg(F.array_join(F.array_sort(F.collect_list("source_id").cast("array<string>")), ",").alias("merged"))
    return out.select("source_id", "action").join(merged, "source_id", "left").fillna("", ["merged"])


def link_pairs(forward: DataFrame, backward: DataFrame, clues: DataFrame, gaps: DataFrame) -> DataFrame:
    """Distinct pairs to judge: both screenings, the clues' targets, and gaps of one domain among themselves."""
    g, h = gaps.select(F.col("node").alias("a"), "domain"), gaps.select(F.col("node").alias("b"), "domain")
    among = g.join(h, "domain").where("a <> b").select("a", "b")
    return forward.select("a", "b").union(backward.select("a", "b")).union(clues.select("a", "b")).union(among).where("a <> b").distinct()


def gap_records(gaps: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Missing fields by default, set fields sorted and distinct."""
    out = gaps
    for name, value in defaults.items():
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(value))) if name in out.columns else out.withColumn(name, F.lit(value))
    for name, kind in out.dtypes:
        if kind.startswith("array"):
            out = out.withColumn(name, F.array_sort(F.array_distinct(F.coalesce(F.col(name), F.array().cast(kind)))))
    return out


def last_lessons(lessons: DataFrame) -> DataFrame:
    return lessons.groupBy("book_id").agg(F.max_by("lesson_id", "position").alias("last_lesson"))


def overlaid(decisions: DataFrame, reviews: DataFrame, overruled: DataFrame | None = None) -> DataFrame:
    """Decisions without those that some round of review rejected, unless the rejection is overruled. All: ``decision_id``."""
    rejected = reviews.where("verdict = 'reject'").select("decision_id").distinct()
    if overruled is not None:
        rejected = rejected.join(overruled.select("decision_id"), "decision_id", "left_anti")
    return decisions.join(rejected, "decision_id", "left_anti")


def applied_grants(points: DataFrame, grants: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Points with their grants overwritten where there are new ones, and ``changed, missing`` counts."""
    new = grants.select("node", F.col("grants").alias("_new"))
    both = points.join(new, "node", "left")
    counts = both.agg(F.count_if(F.col("_new").isNotNull() & ~F.col("_new").eqNullSafe(F.col("grants"))).alias("changed"), F.count_if(F.col("_new").isNull()).alias("missing"))
    return both.withColumn("grants", F.coalesce("_new", "grants")).drop("_new"), counts


def example_pool(texts: DataFrame, most: int = 4, length: int = 170) -> DataFrame:
    """The first examples of each owner by tier (primary here, secondary here, elsewhere), then order, unknown ones last; texts are cut. ``owner, tier, ord, text``."""
    n = F.row_number().over(Window.partitionBy("owner").orderBy(F.asc_nulls_last("tier"), F.asc_nulls_last("ord")))
    return texts.withColumn("n", n).where(F.col("n") <= most).withColumn("text", F.substring("text", 1, length))


def probe_jobs(lessons: DataFrame, dimensions: list[str], per_grade: int = 3, least: int = 3, seed: int = 0) -> DataFrame:
    """Lessons to probe: of each dimension and grade some by seeded md5, of those with enough points so far and not of the last book.

    ``lessons``: ``lesson_id, book, grade, points_so_far``.
    """
    last = lessons.agg(F.max("book").alias("_last"))
    rows = lessons.crossJoin(F.broadcast(last)).where((F.col("book") < F.col("_last")) & (F.col("points_so_far") >= least)).select("lesson_id", "grade", F.explode(F.array(*(F.lit(d) for d in dimensions))).alias("dimension"))
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), "dimension", F.col("lesson_id").cast("string")))
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy("dimension", "grade").orderBy(order, "lesson_id"))).where(F.col("_n") <= per_grade).drop("_n")


def reusable_cards(groups: DataFrame, cards: DataFrame) -> DataFrame:
    """Groups with the card of exactly the same items, if there is one. ``groups``: ``group_id, items``; ``cards``: ``card_id, items``."""
    key = lambda c: F.array_join(F.array_sort(F.array_distinct(c)).cast("array<string>"), ",")
    known = cards.withColumn("_k", key(F.col("items"))).groupBy("_k").agg(F.min("card_id").alias("card_id"))
    return groups.withColumn("_k", key(F.col("items"))).join(known, "_k", "left").drop("_k")


def downgraded(cards: DataFrame, failed: DataFrame) -> DataFrame:
    """Cards whose check failed become ``human`` ones without a solver."""
    f = failed.select("card_id").distinct().withColumn("_f", F.lit(True))
    out = cards.join(f, "card_id", "left")
    return out.withColumn("verifiable_type", F.when(F.col("_f"), "human").otherwise(F.col("verifiable_type"))).withColumn("solver", F.when(F.col("_f"), None).otherwise(F.col("solver"))).drop("_f")


def default_answer_form(histogram: DataFrame) -> DataFrame:
    """Most frequent form of each card, the first on ties: ``card_id, form, n, ord``."""
    return histogram.groupBy("card_id").agg(F.max_by("form", F.struct("n", -F.col("ord"))).alias("form"))


def repair_mode(unresolved: Column, none_of_20: Column, unrenderable: Column) -> Column:
    return F.when(unresolved > 0, "placeholders").when(none_of_20 > 5, "none").when(unrenderable, "render")


def job_rows(members: DataFrame) -> DataFrame:
    """Jobs of ``group_id, item_id, text, secondary, contexts``: sorted distinct references, texts in order of item."""
    flat = lambda c: F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))), ",")
    return members.groupBy("group_id").agg(flat("secondary").alias("secondary"), flat("contexts").alias("contexts"), F.array_sort(F.collect_list(F.struct("item_id", "text"))).alias("texts"), F.count(F.lit(1)).alias("n"))


def inverted(rows: DataFrame, owner: str, listed: str, item: str) -> DataFrame:
    return rows.select(F.explode(listed).alias(item), owner).distinct()


def appended(log: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """A log with new records: a failed old one is replaced by the new one of its id, other old ones stay, new ids are added."""
    fresh = new.join(log.where("status <> 'failed'").select(key), key, "left_anti")
    return log.join(fresh.select(key), key, "left_anti").unionByName(fresh)


def source_hash(files: DataFrame) -> DataFrame:
    """One SHA-256 over the sorted names and digests of ``path, sha256``."""
    listed = files.agg(F.array_sort(F.collect_list(F.concat_ws(":", "path", "sha256"))).alias("l"))
    return listed.select(F.sha2(F.array_join("l", "\n"), 256).alias("source_hash"))


def outdated(items: DataFrame, cache: DataFrame, key: str = "card_id", digest: str = "card_hash") -> DataFrame:
    """Items whose digest is not the cached one (or that are not cached)."""
    c = cache.select(key, F.col(digest).alias("_old"))
    return items.join(c, key, "left").where(~F.col(digest).eqNullSafe(F.col("_old"))).drop("_old")


def last_record(history: DataFrame, group: str, at: str, split: str = "test") -> DataFrame:
    rest = [c for c in history.columns if c not in (group, "split")]
    return history.where(F.col("split") == split).groupBy(group).agg(*(F.max_by(c, at).alias(c) for c in rest))


def rendered_evidence(rows: DataFrame) -> Column:
    """One line of a pair's evidence; parts without content are left out."""
    return F.concat_ws(
        "; ",
        F.when(F.col("cooccurrence") > 0, F.format_string("together %d (%.2f)", F.col("cooccurrence"), F.col("cooccurrence_ratio"))),
        F.when(F.col("reverse_cooccurrence") > 0, F.format_string("reverse %d", F.col("reverse_cooccurrence"))),
        F.when(F.col("same_thread"), "same thread"),
        F.when(F.col("adjacent"), "adjacent"),
        F.when(F.col("conflict"), "order conflict"),
    )


def not_once(expected: DataFrame, used: DataFrame, key: str) -> DataFrame:
    """Audit: keys that are missing, repeated or unknown, with their number of uses."""
    e = expected.select(key).distinct().withColumn("_e", F.lit(1))
    u = used.groupBy(key).agg(F.count(F.lit(1)).alias("uses"))
    out = e.join(u, key, "full").select(key, F.coalesce("uses", F.lit(0)).cast("long").alias("uses"), F.col("_e").isNotNull().alias("expected"))
    return out.where("uses <> 1 OR NOT expected")


def symmetric_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    x, y = a.select(key).distinct(), b.select(key).distinct()
    return x.join(y, key, "left_anti").withColumn("side", F.lit("left")).unionByName(y.join(x, key, "left_anti").withColumn("side", F.lit("right")))


def change_log(moves: DataFrame, drops: DataFrame, gaps: DataFrame, edges: DataFrame) -> DataFrame:
    """Typed rows ``kind, key, detail`` of four sorts of change."""
    out = None
    for kind, df in (("move", moves), ("drop", drops), ("gap", gaps), ("edge", edges)):
        part = df.select(F.lit(kind).alias("kind"), F.col("key").cast("string").alias("key"), F.col("detail").cast("string").alias("detail"))
        out = part if out is None else out.unionByName(part)
    return out


def partition_or_whole(groups: DataFrame, proposals: DataFrame) -> DataFrame:
    """Proposed subgroups of each group, if they are an exact partition of its members, else the group as it is.

    ``groups``: ``group_id, item_id``; ``proposals``: ``group_id, part, item_id``. Returns ``item_id, group_id, part``.
    """
    mine = groups.groupBy("group_id").agg(F.array_sort(F.collect_list("item_id")).alias("m"))
    theirs = proposals.groupBy("group_id").agg(F.array_sort(F.collect_list("item_id")).alias("p"))
    valid = mine.join(theirs, "group_id").where(F.col("m") == F.col("p")).select("group_id", F.lit(True).alias("_ok"))
    good = proposals.join(valid, "group_id", "left_semi")
    return groups.join(good.select("group_id", "item_id", F.col("part").alias("_part")), ["group_id", "item_id"], "left").select("item_id", "group_id", F.coalesce("_part", F.lit(0)).alias("part"))


def standard_coverage(judged: DataFrame, points: DataFrame, *phases: str) -> DataFrame:
    """Coverage of a standard's items before (``pre``) or after (``post``) gaps were filled, or both.

    ``judged``: ``item_id, point, covered, nodes`` (an array); ``points``: ``node, provenance``.
    Before, only points of textbooks count. Returns ``item_id, phase, verdict, nodes`` (the known
    ones, sorted, each once) and ``missing``, the points not covered, sorted and joined.

    Judgments and the known nodes that they cite (two of each, more or less) meet once, by item, in tasks of bounded rows.
    """
    if not phases or set(phases) - {"pre", "post"}:
        raise ValueError("phase is pre or post")
    spark, n = judged.sparkSession, judged.count()
    known = points.groupBy("node").agg(F.coalesce(F.bool_or(F.col("provenance") == "textbook"), F.lit(False)).alias("_pre"))
    # A null item equals no other: its nodes are cited by none.
    each = judged.where("item_id IS NOT NULL").select("item_id", F.explode("nodes").alias("node"))
    cited = each.repartition(tasks_of(spark, 2 * n), "node").join(known, "node")
    met = F.coalesce("covered", F.lit(False))
    rows = judged.select("item_id", met.alias("_met"), "point").unionByName(cited.select("item_id", "node", "_pre"), allowMissingColumns=True)
    judgment = F.col("_met").isNotNull()
    listed = {"pre": F.when(F.col("_pre"), F.col("node")), "post": F.col("node")}
    items = rows.repartition(tasks_of(spark, 3 * n), "item_id").groupBy("item_id").agg(
        verdict(F.count_if("_met"), F.count_if(judgment)).alias("verdict"),
        F.array_join(F.array_sort(F.collect_list(F.when(~F.col("_met"), F.col("point")))), "; ").alias("missing"),
        *(F.array_sort(F.collect_set(listed[p])).alias(f"_{p}") for p in phases),
    )
    by_phase = F.explode(F.array(*(F.struct(F.lit(p).alias("phase"), F.col(f"_{p}").alias("nodes")) for p in phases)))
    return items.select("item_id", "verdict", "missing", by_phase.alias("_of")).select("item_id", "_of.phase", "verdict", "_of.nodes", "missing")
