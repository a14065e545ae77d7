"""Who reaches whom, without all pairs: peeling, strong components, redundant edges, minima of descendants.

Edges are ``src, dst`` rows; rows with a null end take no part. Loops run over whole frontiers; each
round is a table in the shared folder. Rounds grow with the depth of the graph, rows never with the
square of its nodes except where a search has to look at them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinworks.operators.components import SMALL
from skeinworks.session import materialise


def plain(edges: DataFrame) -> DataFrame:
    return edges.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL").distinct()


def turned(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))


def peeled(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``level, src, dst`` of the edges whose source is on no cycle and behind none, and the edges that are left.

    The level is the longest path (in edges) that ends at the source. A round takes the edges of all
    nodes that nothing leads to any more, so an edge is read as often as its level.
    """
    rest = materialise(plain(edges), "rest")
    gone = rest.limit(0).select(F.lit(0).alias("level"), "src", "dst")
    n, level = rest.count(), 0
    while n:
        led_to = rest.select(F.col("dst").alias("src"), F.lit(True).alias("_held")).distinct()
        marked = materialise(rest.join(led_to, "src", "left").select("src", "dst", F.coalesce("_held", F.lit(False)).alias("held")), "peel")
        rest, ready = marked.where("held").select("src", "dst"), marked.where("NOT held")
        left = rest.count()
        if left == n:
            break
        gone = gone.union(ready.select(F.lit(level).alias("level"), "src", "dst"))
        n, level = left, level + 1
    return gone, rest


def node_levels(levelled: DataFrame) -> DataFrame:
    """``node, depth`` of every end of peeled edges: the longest path that ends there."""
    ends = levelled.select(F.col("src").alias("node"), F.col("level").alias("depth")).union(levelled.select("dst", F.col("level") + 1))
    return ends.groupBy("node").agg(F.max("depth").alias("depth"))


def strong_components(edges: DataFrame, small: int = SMALL) -> DataFrame:
    """``node, component`` of the nodes on cycles, loops included; a component is named by its largest node. None for a DAG.

    Up to ``small`` distinct edges, counted beforehand, are walked in one task. Of larger graphs what
    nothing leads to, or what leads to nothing, is peeled away. On the rest the largest node that
    reaches each node spreads as its colour, and the nodes that lead back to that largest node inside
    their colour are its component; edges between colours are on no cycle. Then the rest is peeled
    again, until it is small or empty.
    """
    rest = materialise(plain(edges), "edges")
    kind = dict(rest.dtypes)["dst"]
    walked = lambda df: df.repartition(1).mapInPandas(_walked, f"node {kind}, component {kind}")
    if rest.count() <= small:
        return walked(rest)
    loops = materialise(rest.where("src = dst").select(F.col("src").alias("node")), "loops")
    rest, done = rest.where("src <> dst"), None
    while True:
        rest = turned(peeled(turned(peeled(rest)[1]))[1])
        n = rest.count()
        if n <= small:
            last = walked(rest) if n else None
            break
        nodes = rest.select(F.col("src").alias("node")).union(rest.select("dst")).distinct()
        colour = spread_least(rest, nodes.select("node", F.col("node").alias("value")), largest=True)
        inside = rest.join(colour.select(F.col("node").alias("src"), F.col("value").alias("_a")), "src").join(colour.select(F.col("node").alias("dst"), F.col("value").alias("component")), "dst").where("_a = component")
        inside = materialise(inside.select("component", "src", "dst"), "inside")
        found = materialise(inside.where("dst = component").select("component", F.col("component").alias("node")).distinct(), "found")
        fresh = found
        while not fresh.isEmpty():
            back = inside.join(fresh.select("component", F.col("node").alias("dst")), ["component", "dst"]).select("component", F.col("src").alias("node")).distinct()
            fresh = materialise(back.join(found, ["component", "node"], "left_anti"), "fresh")
            found = materialise(found.union(fresh), "found")
        done = found if done is None else done.union(found)
        taken = found.select("node")
        rest = inside.select("src", "dst").join(taken, F.col("src") == F.col("node"), "left_anti").join(taken, F.col("dst") == F.col("node"), "left_anti")
    if last is not None:
        last = materialise(last, "found")
        done = last if done is None else done.unionByName(last)
    alone = loops if done is None else loops.join(done, "node", "left_anti")
    alone = alone.select("node", F.col("node").alias("component"))
    return alone if done is None else alone.union(done.select("node", "component"))


def _walked(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One walk in depth; a stack of the nodes that are open and one of those that may begin a component."""
    after: dict = {}
    for pdf in it:
        for a, b in zip(pdf["src"].tolist(), pdf["dst"].tolist(), strict=True):
            after.setdefault(a, []).append(b)
    place: dict = {}
    closed, nodes, names = set(), [], []
    for start in after:
        if start in place:
            continue
        place[start] = len(place)
        open_, begins, walk = [start], [start], [(start, iter(after[start]))]
        while walk:
            node, rest = walk[-1]
            for nxt in rest:
                if nxt not in place:
                    place[nxt] = len(place)
                    open_.append(nxt)
                    begins.append(nxt)
                    walk.append((nxt, iter(after.get(nxt, ()))))
                    break
                if nxt not in closed:
                    while place[begins[-1]] > place[nxt]:
                        begins.pop()
            else:
                walk.pop()
                if begins[-1] == node:
                    begins.pop()
                    members = [open_.pop()]
                    while members[-1] != node:
                        members.append(open_.pop())
                    closed.update(members)
                    if len(members) > 1 or node in after.get(node, ()):
                        nodes += members
                        names += [max(members)] * len(members)
    yield pd.DataFrame({"node": nodes, "component": names})


def spread_least(edges: DataFrame, values: DataFrame, largest: bool = False) -> DataFrame:
    """``node, value``: the least ``value`` of a node and all that leads to it (with ``largest`` the greatest); cycles are allowed.

    Only nodes whose value changed push it on. Nodes without a row or with a null have no value of
    their own and pass on others'.
    """
    best = F.max if largest else F.min
    better = "_to > value OR value IS NULL" if largest else "_to < value OR value IS NULL"
    e = materialise(plain(edges), "edges")
    nodes = e.select(F.col("src").alias("node")).union(e.select("dst")).union(values.select("node")).distinct()
    own = values.groupBy("node").agg(best("value").alias("value"))
    current = materialise(nodes.join(own, "node", "left").select("node", "value"), "spread")
    changed = current.where("value IS NOT NULL")
    while True:
        pushed = changed.join(e, changed["node"] == e["src"]).groupBy(F.col("dst").alias("node")).agg(best("value").alias("_to"))
        changed = materialise(pushed.join(current, "node").where(better).select("node", F.col("_to").alias("value")), "changed")
        if changed.isEmpty():
            return current
        new = current.join(changed.select("node", F.col("value").alias("_to")), "node", "left")
        current = materialise(new.select("node", F.coalesce("_to", "value").alias("value")), "spread")


def shortcut_edges(edges: DataFrame) -> DataFrame:
    """Edges ``src, dst`` of a DAG beside a path of exactly two edges.

    The three edges are found from the node with the fewest edges of the three, so that at most
    m * sqrt(m) pairs of m edges are looked at, whatever hubs there are.
    """
    return _shortcuts(materialise(plain(edges), "edges"))


def _shortcuts(e: DataFrame) -> DataFrame:
    degree = e.select(F.col("src").alias("node")).union(e.select("dst")).groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    with_degrees = e.join(degree.select(F.col("node").alias("src"), F.col("n").alias("_s")), "src").join(degree.select(F.col("node").alias("dst"), F.col("n").alias("_d")), "dst")
    low = F.struct(F.col("_s").alias("n"), F.col("src").alias("node")) < F.struct(F.col("_d").alias("n"), F.col("dst").alias("node"))
    arms = materialise(with_degrees.select(F.when(low, F.col("src")).otherwise(F.col("dst")).alias("low"), F.when(low, F.col("dst")).otherwise(F.col("src")).alias("high"), low.alias("away")), "arms")
    other = arms.select("low", F.col("high").alias("y"), F.col("away").alias("to_y"))
    wedges = arms.select("low", F.col("high").alias("x"), F.col("away").alias("to_x")).join(other, "low").where("x <> y")
    # The third edge runs from x to y; every pair of arms comes in both orders.
    closed = wedges.join(e.select(F.col("src").alias("x"), F.col("dst").alias("y")), ["x", "y"])
    first = F.when(F.col("to_x"), F.col("low")).otherwise(F.col("x"))
    last = F.when(F.col("to_y"), F.col("y")).otherwise(F.col("low"))
    return closed.select(first.alias("src"), last.alias("dst")).distinct()


def redundant_edges(edges: DataFrame, small: int = SMALL) -> DataFrame:
    """Edges ``src, dst`` (a, b) with some edge (a, c) and a path of at least one edge from c to b.

    In a DAG these are the edges with a longer path beside them. Of a graph with cycles every edge that
    has an end on a cycle is one, and cycles count as one node for the others.
    """
    levelled, rest = peeled(edges)
    if rest.isEmpty():
        return _redundant(levelled)
    e = materialise(plain(edges), "edges")
    strong = materialise(strong_components(rest, small), "strong")
    a, b = strong.select(F.col("node").alias("src"), F.col("component").alias("_a")), strong.select(F.col("node").alias("dst"), F.col("component").alias("_b"))
    marked = materialise(e.join(a, "src", "left").join(b, "dst", "left"), "marked")
    # A cycle is named by one of its nodes, so no other node has that name.
    folded = marked.select(F.coalesce("_a", "src").alias("src"), F.coalesce("_b", "dst").alias("dst")).where("src <> dst")
    looped = marked.where("_a IS NOT NULL OR _b IS NOT NULL").select("src", "dst")
    between = marked.where("_a IS NULL AND _b IS NULL").select("src", "dst")
    return looped.union(between.join(_redundant(peeled(folded)[0]), ["src", "dst"], "left_semi"))


def _redundant(levelled: DataFrame) -> DataFrame:
    """Redundant edges of a DAG from its peeled edges.

    An edge over one level has no path beside it, an edge beside a path of two edges is found as a
    shortcut; only the others are searched for, from their sources and below their targets' levels,
    over the edges that are no shortcuts, all targets of a source in one search.
    """
    levelled = materialise(levelled, "levelled")
    depth = node_levels(levelled)
    e = levelled.select("src", "dst")
    short = materialise(_shortcuts(e), "shortcuts")
    deep = depth.select(F.col("node").alias("dst"), F.col("depth").alias("to"))
    wanted = levelled.join(deep, "dst").where("to - level > 2").select("src", "dst", "to").join(short, ["src", "dst"], "left_anti")
    wanted = materialise(wanted, "wanted")
    if wanted.isEmpty():
        return short
    step = materialise(e.join(short, ["src", "dst"], "left_anti").join(deep, "dst").select(F.col("src").alias("node"), F.col("dst").alias("next"), "to"), "step")
    found = short
    frontier = wanted.select("src", F.col("src").alias("node")).distinct()
    seen = None
    while True:
        bound = wanted.groupBy("src").agg(F.max("to").alias("_most"))
        far = frontier.join(step, "node").select("src", F.col("next").alias("node"), "to").join(bound, "src")
        # A node at the level of the deepest target is looked at and leads no further.
        fresh = far.where("to <= _most").select("src", "node", "to").distinct()
        if seen is None:
            frontier = materialise(fresh.select("src", "node"), "frontier")
            seen = frontier.limit(0)
        else:
            frontier = materialise(fresh.select("src", "node").join(seen, ["src", "node"], "left_anti"), "frontier")
            got = materialise(wanted.join(frontier.withColumnRenamed("node", "dst"), ["src", "dst"], "left_semi"), "got")
            found = found.union(got.select("src", "dst"))
            wanted = materialise(wanted.join(got, ["src", "dst"], "left_anti"), "wanted")
            seen = materialise(seen.union(frontier), "seen")
        if wanted.isEmpty() or frontier.isEmpty():
            return found
