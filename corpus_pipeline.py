"""From raw documents to packed training sequences, in stages that each call one operator.

Every stage reads all that its predecessor kept, written as Parquet in the shared folder. All stages
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skeinworks.llm import language_id, toxicity
from skeinworks.llm._common import crc_mod
from skeinworks.llm.jaccard_join import keep_first
from skeinworks.llm.packing import pack
from skeinworks.llm.queries import vocabulary
from skeinworks.session import materialise, ship, table


def identified_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and those whose likeliest language has a probability below 0.3."""
    return language_id.keep_identified(docs, language_id.train(docs, learn=crc_mod("doc_id", 4) != 2), least=0.3)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that score 0.7 or more."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels"), learn=crc_mod("doc_id", 3) != 1), limit=0.7)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the least id of each group linked by 0.8 or more of their five-word shingles."""
    return keep_first(docs, words=5, percent=80)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, in sequences of at most 1024 tokens."""
    return pack(docs, vocabulary("byte_bpe_50k.json"), length=1024)


STAGES = [
    ("language_id", identified_language),
    ("toxicity", not_toxic),
    ("near_duplicates", without_near_duplicates),
    ("packing", packed),
]

#: SQL has no form of trained models, tokenizers and packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(ship(spark), sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs = materialise(docs, name)
    return docs
