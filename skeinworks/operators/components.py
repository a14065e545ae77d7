"""Connected components: small graphs by union-find in one task, larger ones by alternating stars.

A round of stars is two aggregations and two joins, never a loop over rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinworks.session import materialise

#: Distinct edges, counted beforehand, that one task joins: some 100 MB at most.
SMALL = 1 << 20


def connected_components(edges: DataFrame, most_rounds: int = 64, small: int = SMALL) -> DataFrame:
    """``node, component`` for every end of an edge (columns ``a``, ``b``); the component is its least node.

    Self loops, repeated edges and both directions are allowed; null ends take no part; no edges give
    no rows. Up to ``small`` distinct edges go to one task, where rounds over the cluster would only
    wait for each other. Beyond that, each round links every node's larger neighbours to its least one, then its smaller ones,
    which leaves a star per component after a number of rounds that grows with the logarithm of the
    longest path. A node with many neighbours is pre-aggregated and its joins can be split by AQE.
    """
    both = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL")
    current, before = materialise(both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges", few=True), None
    if current.count() <= small:
        kind = dict(current.dtypes)["a"]
        return current.repartition(1).mapInPandas(_joined, f"node {kind}, component {kind}")
    loops = materialise(current.select(F.col("a").alias("node")).union(current.select("b")).distinct(), "nodes", few=True)
    current = current.where("a <> b")
    for _ in range(most_rounds):
        # Large star: a node's larger neighbours meet its least neighbour (or itself).
        around = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = around.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # Small star: a node and its smaller neighbours meet the least of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        current = materialise(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges", few=True)
        state = current.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (state.n, state.h) == before:
            break
        before = (state.n, state.h)
    else:
        raise RuntimeError(f"no end after {most_rounds} rounds")
    return loops.join(current.select(F.col("a").alias("node"), F.col("b").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def _joined(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    parent: dict = {}

    def root(x):
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for pdf in it:
        for a, b in zip(pdf["a"].tolist(), pdf["b"].tolist(), strict=True):
            x, y = root(parent.setdefault(a, a)), root(parent.setdefault(b, b))
            parent[max(x, y)] = min(x, y)
    nodes = list(parent)
    yield pd.DataFrame({"node": nodes, "component": [root(x) for x in nodes]})
