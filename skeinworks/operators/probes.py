"""Probes of generated exercises: whether cards generate, and stay within the boundary of their lessons."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinworks.functions.cards import params_features
from skeinworks.functions.generate import instantiate_many
from skeinworks.functions.scalars import wilson
from skeinworks.operators import lattice

NEEDS = "item_id string, card_id string, dimension string, op string, token string, need long"


def generated_needs(cards: DataFrame, samples: int = 20, seed0: int = 4242) -> DataFrame:
    """What seeded exercises of each card (``card_id, card``) need of a boundary: one row a need, one with null dimension without any."""
    seeds = cards.select("card_id", "card", F.explode(F.sequence(F.lit(seed0).cast("long"), F.lit(seed0 + samples - 1).cast("long"))).alias("seed"))
    made = instantiate_many(seeds).where("error IS NULL").join(cards.select("card_id", "card"), "card_id")

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for card_id, seed, params, card in zip(pdf.card_id, pdf.seed, pdf.params, pdf.card, strict=True):
                f, item = params_features(json.loads(params), json.loads(card)["slots"]), f"{card_id}#{seed}"
                needs = [("integer_domain", None, f["integer_max"]), ("decimal_places", None, f["decimal_places"])]
                rows = [(item, card_id, d, None, t, n) for d, t, n in needs if n] + [(item, card_id, "fraction_types", None, t, None) for t in f["fraction_types"]]
                out += rows or [(item, card_id, None, None, None, None)]
            yield pd.DataFrame(out, columns=["item_id", "card_id", "dimension", "op", "token", "need"]).astype({"need": "Int64"})

    return made.select("card_id", "seed", "params", "card").mapInPandas(run, NEEDS)


def bounds_probe(needs: DataFrame, card_lessons: DataFrame, facts: DataFrame, lessons: DataFrame) -> DataFrame:
    """``card_id, n, ok, p, lo, hi``: how many generated exercises stay within the boundary of the card's lesson (``card_id, lesson_id``)."""
    rows = needs.join(card_lessons, "card_id")
    _, reports = lattice.check_items(rows.withColumn("dimension", F.coalesce("dimension", F.lit("none"))).select("item_id", "lesson_id", "dimension", "op", "token", "need"), facts, lessons)
    judged = reports.join(needs.select("item_id", "card_id").distinct(), "item_id")
    out = judged.groupBy("card_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("verdict") == "in").alias("ok"))
    return out.withColumn("w", wilson(F.col("ok"), F.col("n"))).select("card_id", "n", "ok", "w.*")


def violating_dimensions(violations: DataFrame) -> DataFrame:
    return violations.groupBy("dimension").agg(F.count(F.lit(1)).alias("n"))
