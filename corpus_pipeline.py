"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that the one before kept, written as Parquet and
read again, and applies one operator of ``metrolens.llm`` to all of them:
documents the quality classifier rejects go; one row of equal texts stays; one
document of each SimHash group stays; sources are mixed to their targets, with
documents dropped or repeated; what is left is packed into sequences of at most
4096 tokens. A lost executor costs the tasks of one stage.

Null or empty texts pass through the filters like any other text; an empty
table gives an empty result. Extra columns are kept up to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolens.llm import exact_dedup, mixing, packing, quality, simhash
from metrolens.llm.common import stage, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labels of ``sf_dir``."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), quality.learnable(F.col("doc_id")))
    return quality.accepted(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that chains of 3 or fewer differing bits connect, the smallest doc_id."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target takes it."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its place in a sequence."""
    return packing.pack_documents(docs, ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_exact_copies),
    ("simhash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: No SQL: the classifier, the fingerprints and the tokenizer are beyond it. Tests hold every stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
