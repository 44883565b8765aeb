"""The registered queries of the operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.llm import (
    collocations,
    conversation_repair,
    decontaminate,
    host_rules,
    mil_quality,
    mixing,
    near_dedup,
    packing,
    piece_counts,
    preference,
    simhash,
    surrogates,
    warc,
)
from parlance.llm.common import table
from parlance.llm.sql import ORACLES  # noqa: F401


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), ngram=2)


def op2_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    key = spark.conf.get("parlance.surrogates.key", "for synthetic tables only")  # a secret of the caller's where data are real
    return surrogates.pseudonymize(docs, key.encode())


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_counts.token_counts(table(spark, sf_dir, "documents"))


def op5_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.judge(table(spark, sf_dir, "documents"))


def op6_mil_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = mil_quality.train(docs, table(spark, sf_dir, "labels"))
    predicted = (F.col("score") >= mil_quality.THRESHOLD).cast("int")
    return mil_quality.scores(docs, model).select(
        "doc_id", mil_quality.held_out().alias("held_out"), "score", predicted.alias("predicted")
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.round_trip(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mixture(table(spark, sf_dir, "documents")).taken()


def op10_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference.format_pairs(preference.crossed_endings(table(spark, sf_dir, "conversations")))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=30, top=2000)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_repair.damaged(table(spark, sf_dir, "conversations"))
    return conversation_repair.digest(conversation_repair.repair(turns, F.col("present")))


def op13_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_minhash_near_dedup, op2_token_packing, op3_pii_surrogates, op4_token_counts, op5_host_rules,
        op6_mil_quality, op7_decontamination, op8_warc, op9_mixing, op10_preference_format,
        op11_collocations, op12_conversation_repair, op13_simhash_near_dedup,
    )
}
