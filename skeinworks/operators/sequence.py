"""Total orders, adjacency, running folds and islands along a sequence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skeinworks.session import materialise


def dense_position(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """Adds the dense 0-based place in the total order of ``order`` (ties by all columns given).

    Rows are dealt out by range and numbered inside their range; a range's offset is the sum of the
    counts before it (one row a range). No task sorts more than its range.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialise(df.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy("_range").count()  # one row a range: at most n
    offsets = counts.select("_range", (F.sum("count").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return ranged.withColumn("_n", inside).join(F.broadcast(offsets), "_range").withColumn(name, (F.coalesce("_offset", F.lit(0)) + F.col("_n")).cast("long")).drop("_range", "_n", "_offset")


def adjacent_pairs(df: DataFrame, group: list[str], order: list[str], node: str) -> DataFrame:
    """``a, b``: each node with the next one of its group."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.select(*group, F.col(node).alias("a"), F.lead(node).over(w).alias("b")).where("b IS NOT NULL")


def top_per_group(df: DataFrame, group: list[str], order: list[Column | str], k: int, name: str = "place") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(name) <= k)


def islands(df: DataFrame, group: list[str], order: list[str], value: str) -> DataFrame:
    """Runs of equal values: ``group..., island, value, first_at, last_at, length`` with the first order column as place."""
    w = Window.partitionBy(*group).orderBy(*order)
    change = F.when(F.col(value).eqNullSafe(F.lag(value).over(w)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    runs = df.withColumn("_new", change).withColumn("island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*group, "island", value).agg(F.min(order[0]).alias("first_at"), F.max(order[0]).alias("last_at"), F.count(F.lit(1)).alias("length"))


def running_max(df: DataFrame, order: str | list[str], value: str, group: list[str] | None = None, name: str = "bound", before: bool = False) -> DataFrame:
    """The largest value so far (with ``before``: without the row itself), in each group if there are any.

    Rows are dealt out by range of group and order, so a group may lie in many tasks. Each range is
    folded apart, and the folds of a group's earlier ranges, at most one row for each range and group,
    are joined.
    """
    order, group = [order] if isinstance(order, str) else order, group or []
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.to_json(F.struct(*group)) if group else F.lit("")
    ranged = materialise(df.repartitionByRange(n, *group, *order).withColumn("_range", F.spark_partition_id()).withColumn("_group", key), "ranged")
    folds = ranged.groupBy("_range", "_group").agg(F.max(value).alias("_m"))
    earlier = folds.select("_range", "_group", F.max("_m").over(Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)).alias("_earlier"))
    inside = F.max(value).over(Window.partitionBy("_range", "_group").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if before else 0))
    return ranged.withColumn("_own", inside).join(earlier, ["_range", "_group"]).withColumn(name, F.greatest("_own", "_earlier")).drop("_range", "_group", "_own", "_earlier")


def place_in_group(df: DataFrame, group: list[str], order: list[str], name: str = "place") -> DataFrame:
    """Adds the dense 0-based place of each row in its group, by ``order``.

    Rows are dealt out by range of group and order, so a large group lies in many tasks and none sorts
    it; a range's offset is the number of its group's rows in earlier ranges (one row for each range and group).
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialise(df.repartitionByRange(n, *group, *order).withColumn("_range", F.spark_partition_id()).withColumn("_group", F.to_json(F.struct(*group))), "ranged")
    counts = ranged.groupBy("_range", "_group").agg(F.count(F.lit(1)).alias("_c"))
    offsets = counts.select("_range", "_group", F.coalesce(F.sum("_c").over(Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_range", "_group").orderBy(*order)) - 1
    return ranged.withColumn("_n", inside).join(offsets, ["_range", "_group"]).withColumn(name, F.col("_offset") + F.col("_n")).drop("_range", "_group", "_n", "_offset")


def first_rank(df: DataFrame, group: list[str], score: str, name: str = "rank") -> DataFrame:
    """Adds the 0-based rank of each row's score in its group, ties with their first, and the size of the group as ``<name>_of``.

    A run of ties may reach over ranges: where one begins is known from the first and last scores of
    each range, two rows for each range and group at most.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A hash splits the runs of ties, so a hot score is sorted by many tasks.
    salted = df.withColumn("_salt", F.xxhash64(*df.columns))
    ranged = materialise(salted.repartitionByRange(n, *group, score, "_salt").withColumn("_range", F.spark_partition_id()).withColumn("_group", F.to_json(F.struct(*group))), "ranged")
    key = ["_range", "_group"]
    edges = ranged.groupBy(*key).agg(F.count(F.lit(1)).alias("_c"), F.min(F.struct(F.col(score).isNotNull().alias("known"), F.col(score).alias("s"))).alias("_first"), F.max(F.struct(F.col(score).isNotNull().alias("known"), F.col(score).alias("s"))).alias("_last"))
    along = Window.partitionBy("_group").orderBy("_range")
    edges = edges.withColumn("_offset", F.coalesce(F.sum("_c").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("_size", F.sum("_c").over(Window.partitionBy("_group")))
    inside = F.rank().over(Window.partitionBy(*key).orderBy(score)) - 1
    # The last run of a range begins at its rank there; of a run over several ranges the least place counts.
    ranked = ranged.withColumn("_n", inside)
    last = ranked.groupBy(*key).agg(F.max("_n").alias("_last_n"))
    edges = materialise(edges.join(last, key).withColumn("_last_at", F.col("_offset") + F.col("_last_n")), "edges")
    starts = edges.select("_group", F.col("_last").alias("s"), F.col("_last_at").alias("at")).union(edges.select("_group", "_first", "_offset")).groupBy("_group", "s").agg(F.min("at").alias("_start"))
    known = edges.join(starts.withColumnRenamed("s", "_first"), ["_group", "_first"]).select(*key, "_first", "_offset", "_start", "_size")
    here = F.struct(F.col(score).isNotNull().alias("known"), F.col(score).alias("s"))
    rank = F.when(here == F.col("_first"), F.col("_start")).otherwise(F.col("_offset") + F.col("_n"))
    return ranked.join(known, key).withColumn(name, rank).withColumn(f"{name}_of", F.col("_size")).drop("_range", "_group", "_salt", "_n", "_first", "_offset", "_start", "_size")


def quantile_level(df: DataFrame, group: list[str], score: str, levels: int = 5, name: str = "level") -> DataFrame:
    """Level 1..levels by the first rank of a score in its group: ties share the first rank."""
    return first_rank(df, group, score, "_rank").withColumn(name, F.least(F.lit(levels), (1 + F.floor(levels * F.col("_rank") / F.col("_rank_of")))).cast("int")).drop("_rank", "_rank_of")


def standard_scores(df: DataFrame, columns: list[str], name: str = "score") -> DataFrame:
    """Sum of population z-scores over all rows (0 where a column does not vary), rounded to 4 places. One row of statistics is broadcast."""
    stats = df.agg(*(F.avg(c).alias(f"_m_{c}") for c in columns), *(F.stddev_pop(c).alias(f"_s_{c}") for c in columns))
    parts = [F.when(F.col(f"_s_{c}") > 0, (F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}")).otherwise(0.0) for c in columns]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return df.crossJoin(F.broadcast(stats)).withColumn(name, F.round(total, 4)).drop(*(f"_{x}_{c}" for c in columns for x in "ms"))


def serial_ids(df: DataFrame, group: str, order: list[str], prefix: Column, name: str = "serial_id") -> DataFrame:
    """``prefix.NN``: a running number in each group, two digits at least."""
    n = (F.col("_place") + 1).cast("string")
    return place_in_group(df, [group], order, "_place").withColumn(name, F.concat(prefix, F.lit("."), F.when(F.length(n) < 2, F.concat(F.lit("0"), n)).otherwise(n))).drop("_place")


def alternate_split(df: DataFrame, group: list[str], order: list[str], name: str = "split") -> DataFrame:
    """Even places of each group go to ``val``, odd ones to ``test``."""
    return place_in_group(df, group, order, "_place").withColumn(name, F.when(F.col("_place") % 2 == 0, "val").otherwise("test")).drop("_place")
