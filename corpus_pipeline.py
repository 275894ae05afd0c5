"""A training-corpus pipeline: each stage works on what the stage before it kept.

``run`` writes each stage's rows as Parquet to the shared folder and reads them again for the next one. All
stages but the last return the columns of documents; the last returns the ids and their digests.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knownby.llm import bpe, exact_dedup, mixing, near_dedup, quality
from knownby.llm.common import store, table
from knownby.llm.queries import MIX_WEIGHTS, RANKS, mix_levels


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier does not reject."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.drop_near_copies(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by target weights, each as often as the mixture takes it."""
    return mixing.select_mixture(docs, mix_levels(), MIX_WEIGHTS)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with their number and the digests of ids and decoded bytes."""
    ranks = bpe.load_ranks(public_tokenizers.path(RANKS))
    return bpe.with_digests(bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks))


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("mixing", mixing_stage),
    ("byte-level BPE", bpe_stage),
]

#: The first stage is a trained model, which SQL cannot express; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
