"""A corpus pipeline over ``documents``: each stage's rows are written as Parquet and read by the next.

Toxic documents go, of exact copies the one with the largest id stays, of near duplicates (five words,
similarity 0.8) the one with the smallest id stays, the rest is put in the order of a mixture of its
sources, and is encoded with byte-level BPE. The result carries the order as ``position``, and as ``slot, place``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusflow.llm.exact_dups import drop_exact_duplicates
from corpusflow.llm.mixing import mixed_order, positioned, scheduled
from corpusflow.llm.near_dups import drop_near_duplicates
from corpusflow.llm.tables import shuffle_partitions, stored, table
from corpusflow.llm.toxicity import drop_toxic, train
from corpusflow.llm.transducer import with_round_trip

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that score 0.3 or more."""
    return drop_toxic(docs, train(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, keeps the document with the largest id."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, keeps the document with the smallest id."""
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts all documents in the order of the mixture; the files that are written follow it, and encoding goes by them."""
    return mixed_order(docs, shuffle_partitions(spark))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, whether decoding them gives its text back, and its turn in the mixture.

    ``position`` is where the files of the stage before have a document, and each source's documents take its
    blocks in that order: ordered by ``position``, and by ``slot, place``, the result is the mixture.
    """
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs, position = positioned(docs)
    rows, block, slot, place = scheduled(docs, order_col=position)
    turn = (F.col(position).alias("position"), F.col(block).alias("block"), F.col(slot).alias("slot"), F.col(place).alias("place"))
    both = with_round_trip(rows.select("doc_id", "source", "text", *turn), ranks)
    return both.select(
        "doc_id",
        "source",
        "position",
        "block",
        "slot",
        "place",
        F.size("ids").cast("long").alias("n_tokens"),
        F.col("decoded").eqNullSafe(F.coalesce("text", F.lit(""))).alias("round_trip"),
        "ids",
    )


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("encoding", encoding),
]

# The toxicity model and the order of the mixture have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``, each to what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
