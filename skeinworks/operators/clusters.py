"""Clusters of links under cannot-link pairs: strongest links join first, and a join that would hold a forbidden pair ends both sides.

Cutting the weakest link of every cluster that holds a forbidden pair, over and over, ends with the
largest clusters of single linkage that hold none. So they are grown instead: links are taken from
the strongest down, and two clusters that must not meet are both finished, as is any cluster whose
strongest link leads to a finished one.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinworks.operators.components import SMALL, connected_components
from skeinworks.session import materialise, tasks_of


def constrained_clusters(links: DataFrame, apart: DataFrame, small: int = SMALL) -> DataFrame:
    """``node, cluster`` from ``a, b, confidence`` links under cannot-link pairs ``a, b``; a cluster is named by its least node.

    ``apart`` may be ``node, ...`` instead: nodes that are equal in all other columns are apart (nulls are equal
    to none). Their pairs are made inside components only, where alone they count.

    While a cluster holds a forbidden pair, its link of the least (confidence, a, b) goes. Repeated
    links count by the highest confidence and a null one is below all; links and pairs with a null end
    take no part; a pair of a node with itself leaves the node alone; no links give no rows.

    Only components that hold a forbidden pair are worked on. Those of up to ``small`` links and pairs,
    counted beforehand, are grown by a union-find, each in one task. In larger ones all clusters that are
    each other's strongest neighbour join at once, round by round, until what is left of the component
    is small. Links between joined clusters fall together, so rounds shrink the component by a share;
    only a path of more than ``small`` links whose confidences rise along it joins one pair a round.
    """
    ends = links.where("a IS NOT NULL AND b IS NOT NULL").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.coalesce(F.col("confidence").cast("double"), F.lit(float("-inf"))).alias("confidence"))
    links = materialise(ends.groupBy("a", "b").agg(F.max("confidence").alias("confidence")), "links")
    labels = materialise(connected_components(links), "labels")
    of_a, of_b = labels.select(F.col("node").alias("a"), F.col("component").alias("ca")), labels.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    if "node" in apart.columns:
        alike = [c for c in apart.columns if c != "node"]
        placed = materialise(apart.dropna().distinct().join(labels, "node"), "placed")
        x, y = (placed.withColumnRenamed("node", c) for c in "xy")
        foes = x.join(y, ["component", *alike]).where("x < y").select("component", "x", "y").distinct()
    else:
        foes = apart.where("a IS NOT NULL AND b IS NOT NULL").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(of_a, "a").join(of_b, "b").where("ca = cb").select(F.col("ca").alias("component"), F.col("a").alias("x"), F.col("b").alias("y"))
    foes = materialise(foes, "foes")
    troubled = foes.select("component").distinct()
    inside = links.where("a <> b").join(of_a, "a").withColumnRenamed("ca", "component").join(troubled, "component", "left_semi")
    inside = materialise(inside.select("component", F.col("a").alias("x"), F.col("b").alias("y"), F.struct("confidence", "a", "b").alias("key")), "inside")
    # A node apart from itself is finished before it starts.
    ended = foes.where("x = y").select("component", F.col("x").alias("cluster")).distinct()
    at = labels.join(troubled, "component", "left_semi").select("node", F.col("node").alias("cluster"))
    while True:
        sizes = inside.select("component").union(foes.select("component")).groupBy("component").count()
        large = materialise(sizes.where(F.col("count") > small).select("component"), "large", few=True)
        if large.isEmpty() or inside.join(large, "component", "left_semi").isEmpty():
            break
        inside, foes, ended, at = _joined_once(inside, foes, ended, at, large)
    kind = dict(labels.dtypes)["node"]
    plain = lambda df, n: df.select("component", "x", "y", F.lit(0.0).alias("confidence"), F.col("x").alias("a"), F.col("y").alias("b"), F.lit(n).alias("kind"))
    open_ = inside.select("component").distinct()
    rows = inside.select("component", "x", "y", "key.*", F.lit(0).alias("kind")).unionByName(plain(foes.join(open_, "component", "left_semi"), 1))
    rows = rows.unionByName(plain(ended.join(open_, "component", "left_semi").select("component", F.col("cluster").alias("x"), F.col("cluster").alias("y")), 2))
    # Components share no node, so many small ones are grown in one call.
    parts = tasks_of(links.sparkSession, inside.count() + foes.count())
    grown = rows.groupBy(F.pmod(F.xxhash64("component"), F.lit(parts)).alias("_part")).applyInPandas(_grown, f"cluster {kind}, final {kind}")
    settled = at.join(grown, "cluster", "left").select("node", F.coalesce("final", "cluster").alias("cluster"))
    calm = labels.join(troubled, "component", "left_anti").select("node", F.col("component").alias("cluster"))
    return calm.unionByName(settled)


def _joined_once(inside: DataFrame, foes: DataFrame, ended: DataFrame, at: DataFrame, large: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """One round in the ``large`` components: clusters that are each other's strongest neighbour join or end."""
    work = inside.join(large, "component", "left_semi")
    done = ended.select(F.col("cluster").alias("c"))
    seen = work.select("component", F.col("x").alias("c"), F.col("y").alias("other"), "key").union(work.select("component", "y", "x", "key"))
    best = seen.join(done, "c", "left_anti").groupBy("component", "c").agg(F.max("key").alias("key"), F.max_by("other", "key").alias("other"))
    best = materialise(best, "best")
    blocked = best.join(done.withColumnRenamed("c", "other"), "other", "left_semi").select("component", F.col("c").alias("cluster"))
    back = best.select(F.col("c").alias("other"), F.col("other").alias("c"), F.col("key").alias("_k"))
    pairs = best.join(back, ["c", "other"]).where("c < other AND key = _k").select("component", F.col("c").alias("x"), F.col("other").alias("y"))
    barred = foes.select(F.col("x").alias("fx"), F.col("y").alias("fy"), F.lit(True).alias("bad")).distinct()
    pairs = materialise(pairs.join(barred, (F.col("x") == F.col("fx")) & (F.col("y") == F.col("fy")), "left").select("component", "x", "y", F.coalesce("bad", F.lit(False)).alias("bad")), "pairs")
    bad = pairs.where("bad")
    ended = materialise(ended.union(blocked).union(bad.select("component", "x")).union(bad.select("component", "y")).distinct(), "ended")
    moved = pairs.where("NOT bad").select(F.col("y").alias("_old"), F.col("x").alias("_new"))

    def renamed(rows: DataFrame, column: str) -> DataFrame:
        return rows.join(moved, F.col(column) == F.col("_old"), "left").withColumn(column, F.coalesce("_new", column)).drop("_old", "_new")

    def ordered(rows: DataFrame) -> DataFrame:
        both = renamed(renamed(rows, "x"), "y")
        return both.withColumn("_x", F.least("x", "y")).withColumn("y", F.greatest("x", "y")).withColumn("x", F.col("_x")).drop("_x")

    # Of the links between two clusters only the strongest counts; between two ended ones none does.
    links = ordered(inside).where("x <> y").groupBy("component", "x", "y").agg(F.max("key").alias("key"))
    flags = ended.select("cluster", F.lit(True).alias("_end"))
    links = links.join(flags.select(F.col("cluster").alias("x"), F.col("_end").alias("_ex")), "x", "left").join(flags.select(F.col("cluster").alias("y"), F.col("_end").alias("_ey")), "y", "left")
    inside = materialise(links.where("_ex IS NULL OR _ey IS NULL").select("component", "x", "y", "key"), "inside")
    foes = materialise(ordered(foes).select("component", "x", "y").distinct(), "foes")
    at = materialise(renamed(at, "cluster").select("node", "cluster"), "at")
    return inside, foes, ended, at


def _grown(pdf: pd.DataFrame) -> pd.DataFrame:
    """Whole components: links from the strongest down, pairs and ended clusters known beforehand."""
    parent = {c: c for c in pdf["x"].tolist() + pdf["y"].tolist()}
    least, weight, foes = dict(parent), dict.fromkeys(parent, 1), {}
    kinds = pdf["kind"].to_numpy()
    ended = set(pdf["x"][kinds == 2].tolist())
    for x, y in zip(pdf["x"][kinds == 1].tolist(), pdf["y"][kinds == 1].tolist(), strict=True):
        foes.setdefault(x, set()).add(y)
        foes.setdefault(y, set()).add(x)

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    links = pdf[kinds == 0].sort_values(["confidence", "a", "b"], ascending=False)
    for x, y in zip(links["x"].tolist(), links["y"].tolist(), strict=True):
        x, y = root(x), root(y)
        if x == y:
            continue
        if x in ended or y in ended or y in foes.get(x, ()):
            ended |= {x, y}
            continue
        # The side with fewer members and pairs moves, so each moves a logarithmic number of times.
        if weight[x] + len(foes.get(x, ())) < weight[y] + len(foes.get(y, ())):
            x, y = y, x
        parent[y], least[x] = x, min(least[x], least[y])
        weight[x] += weight[y]
        for other in foes.pop(y, ()):
            foes[other].discard(y)
            foes[other].add(x)
            foes.setdefault(x, set()).add(other)
    clusters = list(parent)
    return pd.DataFrame({"cluster": clusters, "final": [least[root(c)] for c in clusters]})
