"""Prerequisite graphs: chains, closure, reduction, cycles, components, longest paths, repairs.

Edges are ``src, dst`` rows. Loops run over whole frontiers as joins; each round is written to the
shared folder, so plans stay short and a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinworks.operators.reachability import node_levels, peeled, redundant_edges, spread_least, strong_components, turned
from skeinworks.session import materialise

#: Rows of a table of points that is broadcast at most.
LISTED = 100_000


def adjacency(edges: DataFrame, nodes: DataFrame, node: str = "node") -> DataFrame:
    """Edges whose ends both exist."""
    ids = nodes.select(F.col(node).alias("_n")).distinct()
    return edges.join(ids, edges["src"] == ids["_n"], "left_semi").join(ids, edges["dst"] == ids["_n"], "left_semi")


def dangling(refs: DataFrame, nodes: DataFrame, node: str = "node") -> DataFrame:
    """References to nodes that there are not."""
    return refs.join(nodes.select(node).distinct(), node, "left_anti").select(refs.columns)


def closure(edges: DataFrame) -> DataFrame:
    """All ``src, dst`` with a path. Paths double in length each round: rounds grow with the logarithm of the depth."""
    known = materialise(edges.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL").distinct(), "closure")
    size = known.count()
    while True:
        step = known.select(F.col("src").alias("dst"), F.col("dst").alias("far"))
        grown = known.union(known.join(step, "dst").select("src", F.col("far").alias("dst"))).distinct()
        known = materialise(grown, "closure")
        n = known.count()
        if n == size:
            return known
        size = n


def _turned_edges(edges: DataFrame, backwards: bool) -> DataFrame:
    return edges.select(*((F.col("dst").alias("src"), F.col("src").alias("dst")) if backwards else ("src", "dst"))).distinct()


def reach(edges: DataFrame, starts: DataFrame, depth: int | None = None, backwards: bool = False, via: bool = True) -> DataFrame:
    """``start, node, depth, via``: everything within ``depth`` of each start, by shortest depth; ``via`` only if wanted.

    ``via`` is the parent that comes first in breadth-first order with neighbours sorted by node. The
    start itself is left out. That order is the order of the paths themselves, node by node, so each
    row of a frontier carries its own (``depth`` nodes) and no frontier is sorted or ranked.
    """
    e = materialise(_turned_edges(edges, backwards), "edges")
    kind = dict(e.dtypes)["dst"]
    frontier = materialise(starts.select("start", F.col("start").alias("node"), F.array().cast(f"array<{kind}>").alias("path")).distinct(), "frontier")
    # What was seen is the rounds themselves, which are not written again.
    seen = frontier.select("start", "node")
    found: list[DataFrame] = []
    at = 0
    while depth is None or at < depth:
        at += 1
        stepped = frontier.join(e, frontier["node"] == e["src"]).select("start", F.col("dst").alias("node"), (F.concat("path", F.array(F.col("node").cast(kind))) if via else F.col("path")).alias("path"))
        fresh = stepped.join(seen, ["start", "node"], "left_anti")
        frontier = materialise(fresh.groupBy("start", "node").agg(F.min("path").alias("path")), "frontier")
        if frontier.isEmpty():
            break
        found.append(frontier.select("start", "node", F.lit(at).alias("depth"), *([F.element_at("path", -1).alias("via")] if via else [])))
        seen = seen.union(frontier.select("start", "node"))
    if not found:
        return frontier.select("start", "node", F.lit(0).alias("depth"), *([F.element_at("path", -1).alias("via")] if via else [])).limit(0)
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out


def nearest_start(edges: DataFrame, starts: DataFrame, backwards: bool = False) -> DataFrame:
    """``node, depth``: how many edges each node lies from the nearest start (``start``) that is not the node itself.

    A node passes on the two starts that reach it first: of them one at least is not the node that is
    reached next, so no further start could be nearer. Rows are two a node at most, whatever reaches it.
    """
    e = materialise(_turned_edges(edges, backwards), "edges")
    front = materialise(starts.select("start").where("start IS NOT NULL").distinct().select(F.col("start").alias("node"), "start", F.lit(0).alias("depth")), "front")
    known, at = front, 0
    while not front.isEmpty():
        at += 1
        told = front.join(e, front["node"] == e["src"]).select(F.col("dst").alias("node"), "start").distinct()
        both = told.withColumn("_new", F.lit(True)).unionByName(known.select("node", "start", F.lit(False).alias("_new")))
        each = both.groupBy("node", "start").agg(F.every("_new").alias("_new"))
        # The two least (known, start) pairs of each node, as aggregates: no list of all starts is held.
        first = each.groupBy("node").agg(F.count_if(~F.col("_new")).alias("_had"), F.min(F.when(F.col("_new"), F.col("start"))).alias("_low"), F.max(F.when(F.col("_new"), F.col("start"))).alias("_high"))
        new = first.where("_had < 2 AND _low IS NOT NULL").select("node", F.explode(F.when(F.col("_had") == 1, F.array("_low")).otherwise(F.array_distinct(F.array("_low", "_high")))).alias("start"), F.lit(at).alias("depth"))
        front = materialise(new, "front")
        known = known.union(front)
    return known.where("node <> start").groupBy("node").agg(F.min("depth").alias("depth"))


def transitive_reduction(edges: DataFrame) -> DataFrame:
    """The edges with ``is_direct``: no longer path beside them. Edges at nodes on cycles are not direct."""
    redundant = redundant_edges(edges).select("src", "dst", F.lit(True).alias("_r"))
    return edges.join(redundant, ["src", "dst"], "left").withColumn("is_direct", F.col("_r").isNull()).drop("_r")


def witnesses(edges: DataFrame) -> DataFrame:
    """For each implied edge, the inner nodes of a shortest path of the reduced graph, joined by commas; edges at nodes on cycles have none.

    Paths start only where an implied edge does, and end when all of its kind are found.
    """
    marked = materialise(transitive_reduction(edges.select("src", "dst").distinct()), "marked")
    direct = marked.where("is_direct").select("src", "dst")
    wanted = materialise(marked.where("NOT is_direct").select("src", "dst"), "wanted")
    paths = direct.select("src", F.col("dst").alias("node"), F.array("dst").alias("path"))
    done = wanted.limit(0).select("src", "dst", F.lit("").alias("implied_via"))
    while not wanted.isEmpty():
        near = paths.join(wanted.select("src").distinct(), "src", "left_semi")
        longer = near.join(direct.select(F.col("src").alias("node"), F.col("dst").alias("far")), "node")
        longer = longer.select("src", F.col("far").alias("node"), F.concat("path", F.array("far")).alias("path"))
        paths = materialise(longer.groupBy("src", "node").agg(F.min("path").alias("path")), "paths")
        if paths.isEmpty():
            break
        got = wanted.join(paths.select("src", F.col("node").alias("dst"), "path"), ["src", "dst"])
        got = materialise(got.select("src", "dst", F.concat_ws(",", F.slice("path", F.lit(1), F.size("path") - 1).cast("array<string>")).alias("implied_via")), "got")
        done = done.unionByName(got)
        wanted = materialise(wanted.join(got, ["src", "dst"], "left_anti"), "wanted")
    return done


def nodes_on_cycles(edges: DataFrame) -> DataFrame:
    """Nodes that reach themselves; none for a DAG."""
    return strong_components(edges).select("node")


def levels(edges: DataFrame) -> DataFrame:
    """``node, depth``: the longest path (in edges) that ends at each node of a DAG. A cycle raises."""
    levelled, rest = peeled(edges)
    if not rest.isEmpty():
        raise ValueError("the graph has a cycle")
    return node_levels(levelled)


def longest_path(edges: DataFrame) -> DataFrame:
    """``place, node`` of one longest path of a DAG, from place 0; no row without edges.

    It ends at the least of the deepest nodes, and each step back goes to the least of the nodes one
    level up. Steps back are joined with themselves, so a path of n nodes takes log2(n) rounds.
    """
    depth = levels(edges)
    upper, lower = depth.select(F.col("node").alias("src"), F.col("depth").alias("_up")), depth.select(F.col("node").alias("dst"), F.col("depth").alias("_low"))
    tight = edges.select("src", "dst").join(upper, "src").join(lower, "dst").where("_up + 1 = _low")
    jump = materialise(tight.groupBy(F.col("dst").alias("node")).agg(F.min("src").alias("back")), "back")
    ends = depth.groupBy("depth").agg(F.min("node").alias("node"))
    on = materialise(ends.agg(F.max_by("node", "depth").alias("node")).where("node IS NOT NULL"), "path")
    further = materialise(on.join(jump, "node").select(F.col("back").alias("node")), "further")
    while not further.isEmpty():
        on = materialise(on.union(further), "path")
        jump = materialise(jump.join(jump.select(F.col("node").alias("back"), F.col("back").alias("_far")), "back").select("node", F.col("_far").alias("back")), "back")
        further = materialise(on.join(jump, "node").select(F.col("back").alias("node")).join(on, "node", "left_anti"), "further")
    return on.join(depth, "node").select(F.col("depth").alias("place"), "node")


def degrees(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, indegree, outdegree`` of every node, 0 where it has none."""
    inn = edges.groupBy(F.col("dst").alias("node")).agg(F.count(F.lit(1)).alias("indegree"))
    out = edges.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("outdegree"))
    return nodes.select("node").join(inn, "node", "left").join(out, "node", "left").fillna(0, ["indegree", "outdegree"])


def order_conflicts(edges: DataFrame, positions: DataFrame) -> DataFrame:
    """Edges whose source comes after their target. ``positions``: ``node, position``."""
    p = positions.select(F.col("node").alias("src"), F.col("position").alias("src_position"))
    q = positions.select(F.col("node").alias("dst"), F.col("position").alias("dst_position"))
    return edges.join(p, "src").join(q, "dst").where("src_position > dst_position").select("src", "dst", "src_position", "dst_position")


def moved_to_fixpoint(edges: DataFrame, positions: DataFrame) -> DataFrame:
    """Positions after moving each source to its earliest dependant: the least of its own and all descendants' positions."""
    least = spread_least(turned(edges), positions.select("node", F.col("position").alias("value")))
    return positions.join(least, "node", "left").select("node", "position", F.least("position", "value").alias("moved_to"))


def placed_gaps(gaps: DataFrame) -> DataFrame:
    """Place of a missing node: ``first_dependant, stage_end, floor, soft_earlier, latest_prerequisite`` -> ``place``.

    The earliest dependant; a soft earlier place if it is not below the floor; the stage's end if that
    is earlier and not below the floor; without dependants the stage's end, but not before the latest
    prerequisite.
    """
    soft = F.when((F.col("soft_earlier") < F.col("first_dependant")) & (F.col("soft_earlier") >= F.col("floor")), F.col("soft_earlier")).otherwise(F.col("first_dependant"))
    capped = F.when((F.col("stage_end") < soft) & (F.col("stage_end") >= F.col("floor")), F.col("stage_end")).otherwise(soft)
    free = F.greatest("stage_end", F.coalesce("latest_prerequisite", "stage_end"))
    return gaps.withColumn("place", F.when(F.col("first_dependant").isNull(), free).otherwise(capped))


def inserted(edges: DataFrame, new: DataFrame) -> DataFrame:
    """New edges that are not there yet, once each, after the present ones."""
    return edges.unionByName(new.dropDuplicates(["src", "dst", "type"]).join(edges, ["src", "dst", "type"], "left_anti").select(edges.columns))


def without_mutual(edges: DataFrame, stages: DataFrame) -> DataFrame:
    """Of two opposite edges the one from the higher stage goes; of the same stage, both. ``stages``: ``node, stage``."""
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")).distinct()
    a = stages.select(F.col("node").alias("src"), F.col("stage").alias("_a"))
    b = stages.select(F.col("node").alias("dst"), F.col("stage").alias("_b"))
    mutual = edges.select("src", "dst").distinct().join(back, ["src", "dst"]).join(a, "src").join(b, "dst").where("_a >= _b").select("src", "dst")
    return edges.join(mutual, ["src", "dst"], "left_anti")


def relations(edges: DataFrame, node: str = "node") -> DataFrame:
    """Undirected kinds seen from each end: ``node, type, other, direction``."""
    out = edges.select(F.col("src").alias(node), "type", F.col("dst").alias("other"), F.lit("out").alias("direction"))
    return out.union(edges.select(F.col("dst").alias(node), "type", F.col("src").alias("other"), F.lit("in").alias("direction")))


def violations(edges: DataFrame, points: DataFrame) -> DataFrame:
    """Broken rules as ``rule, src, dst``: missing ends, self loops, repeated and mutual edges, edges against the order, nodes on cycles, wrong ``is_direct`` marks.

    ``edges``: ``src, dst, is_direct``; ``points``: ``node, position``. A sound graph gives no rows.
    """
    e = edges.select("src", "dst", "is_direct")
    pair = e.select("src", "dst").distinct()
    ids = points.select("node").distinct()

    def rule(name: str, rows: DataFrame) -> DataFrame:
        return rows.select(F.lit(name).alias("rule"), "src", "dst")

    known = adjacency(pair, ids)
    out = rule("missing end", pair.join(known, ["src", "dst"], "left_anti"))
    out = out.union(rule("self loop", pair.where("src = dst")))
    out = out.union(rule("repeated", e.groupBy("src", "dst").count().where("count > 1")))
    out = out.union(rule("mutual", pair.join(pair.select(F.col("dst").alias("src"), F.col("src").alias("dst")), ["src", "dst"]).where("src < dst")))
    out = out.union(rule("against order", order_conflicts(pair, points)))
    out = out.union(rule("cycle", nodes_on_cycles(pair).select(F.col("node").alias("src"), F.col("node").alias("dst"))))
    marked = transitive_reduction(pair).withColumnRenamed("is_direct", "_right")
    return out.union(rule("wrong mark", e.distinct().join(marked, ["src", "dst"]).where("coalesce(is_direct, true) <> _right")))


def placement_violations(points: DataFrame, lessons: DataFrame, listed: DataFrame, reviews: DataFrame, edges: DataFrame) -> DataFrame:
    """Broken rules of where points are taught, as ``rule, node, lesson_id``; sound data give no rows.

    ``points``: ``node, lesson_id`` (of the introduction), ``origin, moved, note``; ``lessons``:
    ``lesson_id, position``; ``listed``: ``lesson_id, node, part`` (``intro`` or ``practice``);
    ``reviews``: ``node, lesson_id``; ``edges``: ``src, dst``. The rules: a lesson lists an unknown
    point; a point's lesson is unknown; a lesson introduces a point of another one; a point is
    introduced and practised in one lesson; a reconciled point is not listed where it is introduced; a
    review precedes the introduction; a moved point stands nowhere one of its successors does; a
    reconciled point has no note.
    """
    p = points.select("node", "lesson_id", "origin", "moved", "note").join(lessons.select("lesson_id", "position"), "lesson_id", "left")
    home = p.select("node", F.col("lesson_id").alias("_home"), F.col("position").alias("_start"))
    seen = listed.select("lesson_id", "node", "part").distinct()
    intro = seen.where("part = 'intro'")
    reconciled = p.where("origin = 'reconciled'")
    starts = edges.select(F.col("src").alias("_src"), F.col("dst").alias("node")).join(home, "node").select(F.col("_src").alias("node"), F.col("_start").alias("position"))

    # Many reviews of few points: these few go to the reviews, so that no task holds all reviews of a point.
    reviewed = materialise(home.join(reviews.select("node").distinct(), "node", "left_semi").select("node", "_start"), "reviewed", few=True)
    reviewed = F.broadcast(reviewed) if reviewed.count() <= LISTED else reviewed

    found = {
        "unknown point": seen.join(home, "node", "left_anti"),
        "no position": p.where("position IS NULL"),
        "introduced elsewhere": intro.join(home, "node").where("NOT lesson_id <=> _home"),
        "introduced and practised": intro.join(seen.where("part = 'practice'"), ["lesson_id", "node"], "left_semi"),
        "not listed": reconciled.join(intro, ["lesson_id", "node"], "left_anti"),
        "review too early": reviews.select("node", "lesson_id").join(lessons.select("lesson_id", "position"), "lesson_id").join(reviewed, "node").where("position < _start"),
        "move not minimal": reconciled.where("moved").join(starts, ["node", "position"], "left_anti"),
        "no note": reconciled.where("coalesce(note, '') = ''"),
    }
    out = None
    for rule, rows in found.items():
        part = rows.select(F.lit(rule).alias("rule"), "node", "lesson_id").distinct()
        out = part if out is None else out.union(part)
    return out


def coverage_violations(items: DataFrame, points: DataFrame) -> DataFrame:
    """Broken rules of a standard's coverage, as ``rule, item_id``.

    ``items``: ``item_id, status, nodes`` (an array), ``reason``; ``points``: ``node``. An item is
    uncovered; it counts as covered by no point or by unknown ones; it does not apply for no reason.
    """
    covered = items.where("status = 'covered'").select("item_id", F.explode_outer("nodes").alias("node"))
    wrong = covered.join(points.select("node").distinct(), "node", "left_anti")
    rule = lambda name, rows: rows.select(F.lit(name).alias("rule"), "item_id").distinct()
    out = rule("uncovered", items.where("status = 'uncovered'")).union(rule("bad reference", wrong))
    return out.union(rule("no reason", items.where("status = 'not_applicable' AND coalesce(reason, '') = ''")))
