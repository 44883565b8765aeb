"""From raw documents to packed token rows: the stages of a training-data pipeline.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; its result is written and read back as the next one's ``docs``. All but
the last return the columns of ``documents``. How each stage treats nulls,
empty and long texts, ties, repeated rows and empty tables stands in the
docstring of its operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parlance.llm import decontaminate, mil_quality, mixing, near_dedup, packing
from parlance.llm.common import prepare, store, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the passage classifier, learned from ``labels``, scores below the threshold."""
    prepare(spark)
    return mil_quality.accepted(docs, mil_quality.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate group (five-word shingles, similarity 0.8)."""
    prepare(spark)
    return near_dedup.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain a test item of ``benchmark``."""
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take the sources' words by target weights."""
    prepare(spark)
    return mixing.mixed_documents(docs)


def token_rows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode and pack into rows of fixed length."""
    prepare(spark)
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality),
    ("minhash_near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("source_mixing", mixture),
    ("token_packing", token_rows),
]

#: The classifier, the seeded mixture and the encoder are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each but the last stored in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
