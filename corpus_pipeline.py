"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the
next stage's ``docs``. All but the last return the columns of ``documents``. Every stage works on all rows and
whole texts of what the one before it kept; nulls, repeated rows, empty tables and further columns are treated as
the operators' docstrings say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hazardlens.llm import blocknames, jaccard, langid, mixing, packing
from hazardlens.llm.common import table
from hazardlens.session import scratch_path


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter and those in none of the languages of ``documents.lang`` go. All labelled documents teach."""
    return langid.keep_known(docs, langid.learn(docs, sample_docs=None), min_score=langid.least_scores(docs))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, the one with the largest id."""
    return blocknames.drop_duplicates(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 stays, the one with the smallest id."""
    return jaccard.keep_one_of_each(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a row for each time that a document is taken, at most three."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 4096 tokens."""
    return packing.packed_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("mixing", mixed_sources),
    ("packing", packed),
]

#: Language identification and near duplicates have no SQL form; tests compare the stages with plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what goes from one to the next lies in the cluster's shared folder."""
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            path = scratch_path(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
