"""Extension: capability introductions kept up to date by Structured Streaming.

A fold of facts is a minimum of positions, so late and repeated facts need no special care: the first
position of a token is a running minimum, and a token's first appearance a deduplication by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

KEY = ["dimension", "op", "token"]


def introductions(facts: DataFrame) -> DataFrame:
    """Streaming ``dimension, op, token, position``: write it with output mode ``update`` (changed tokens) or ``complete``."""
    return facts.where("token IS NOT NULL").groupBy(*KEY).agg(F.min("position").alias("position"))


def first_events(events: DataFrame, keys: list[str], at: str, watermark: str) -> DataFrame:
    """The first event of each key seen within the watermark; state older than it is dropped."""
    return events.withWatermark(at, watermark).dropDuplicatesWithinWatermark(keys)


def windowed_counts(events: DataFrame, at: str, group: list[str], width: str, watermark: str) -> DataFrame:
    """Counts by tumbling window; windows older than the watermark are final."""
    return events.withWatermark(at, watermark).groupBy(F.window(at, width).alias("w"), *group).count().select("w.start", "w.end", *group, "count")


def start_introductions(facts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends each batch's changed introductions to a table; readers take the minimum by key."""

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(path)

    return introductions(facts).writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(save).start()
