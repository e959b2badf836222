"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that the one before it kept. The first four return
documents, with the same columns; the last returns the pieces of the sequences.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from public_tokenizers import path
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabfold.llm import mixing, packing, repeats, simhash, toxicity
from tabfold.llm.common import settle, small_batches, table
from tabfold.llm.queries import TOKENIZER, toxicity_lexicon

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """The stage, with rows going to Python workers by the megabyte."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


@in_small_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon, learned from the labelled ones, does not reject."""
    return toxicity.without_toxic(docs, toxicity_lexicon(docs, table(spark, sf_dir, "labels")))


@in_small_batches
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group whose SimHash fingerprints are linked."""
    return simhash.one_per_group(docs)


@in_small_batches
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has, and their new lengths."""
    return repeats.without_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


@in_small_batches
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences with their token ids."""
    return packing.pack(docs, path(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Fingerprints, repeats and tokens have no SQL form; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
