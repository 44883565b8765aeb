"""Rare-intent filter and exact stratified train/val/test split.

Sizes follow the stratified shuffle split the original used, twice in a row:

* first cut: ``n_test = ceil(test_split * n)`` (in DOUBLE, as the original
  did in float), ``n_tv = n - n_test``;
* second cut on the rest: ``n_val = ceil(val_ratio * n_tv)``;
* each cut gives class ``i`` the quota ``floor(c_i * n_keep / n)`` plus one
  for the ``n_keep - sum(floor)`` classes with the largest remainders
  (ties by intent name); the other side gets the rest of the class.

Membership: rows of an intent ordered by ``md5('<seed>:<row_id>')`` (then
``row_id``); the first ``q_train`` are train, the next up to ``q_tv`` val,
the rest test.  Only the tiny per-intent count table is windowed globally.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parlance.config import DEFAULT, Settings, scratch_path
from parlance.operators.positions import bucket_offsets, hash_bucket, rank_with_offsets, seeded_key


def intent_counts(df: DataFrame, intent: str = "intent") -> DataFrame:
    """A4 on the intent column: rows per non-null intent (partial aggregation)."""
    return df.where(F.col(intent).isNotNull()).groupBy(intent).agg(F.count(F.lit(1)).alias("c"))


def rare_intents(df: DataFrame, threshold: int | None = None, intent: str = "intent") -> DataFrame:
    """intents with fewer than ``threshold`` rows."""
    t = DEFAULT.rare_threshold if threshold is None else threshold
    return intent_counts(df, intent).where(F.col("c") < t).select(intent)


def anti_join_rare(df: DataFrame, threshold: int | None = None, intent: str = "intent") -> DataFrame:
    """Drop rows of rare intents and rows without an intent."""
    rare = rare_intents(df, threshold, intent)
    return df.where(F.col(intent).isNotNull()).join(rare, intent, "left_anti")


def _largest_remainder(counts: DataFrame, c: str, n_keep: str, n: str, out: str, intent: str) -> DataFrame:
    """Quota per class: floor(c*n_keep/n) plus one for the largest remainders.

    ``counts`` holds one row per class (small), so the un-partitioned window
    over it is cheap.
    """
    dec = "decimal(38,0)"
    prod = F.col(c).cast(dec) * F.col(n_keep).cast(dec)
    tmp = counts.withColumn("_base", F.floor(prod / F.col(n).cast(dec)).cast("bigint")).withColumn(
        "_rem", prod - F.col("_base").cast(dec) * F.col(n).cast(dec)
    )
    whole = Window.partitionBy(F.lit(0))
    ranked = Window.partitionBy(F.lit(0)).orderBy(F.col("_rem").desc(), F.col(intent))
    tmp = tmp.withColumn("_extra", F.col(n_keep) - F.sum("_base").over(whole)).withColumn(
        "_rk", F.row_number().over(ranked)
    )
    return tmp.withColumn(
        out, (F.col("_base") + F.when(F.col("_rk") <= F.col("_extra"), 1).otherwise(0)).cast("bigint")
    ).drop("_base", "_rem", "_extra", "_rk")


def split_quotas(counts: DataFrame, settings: Settings = DEFAULT, intent: str = "intent") -> DataFrame:
    """Per intent: ``c``, ``q_tv`` (train+val rows) and ``q_train``."""
    whole = Window.partitionBy(F.lit(0))
    q = counts.withColumn("_n", F.sum("c").over(whole).cast("bigint"))
    q = q.withColumn("_n_tv", F.col("_n") - F.ceil(F.lit(float(settings.test_split)) * F.col("_n")))
    q = _largest_remainder(q, "c", "_n_tv", "_n", "q_tv", intent)
    q = q.withColumn("_n_tr", F.col("_n_tv") - F.ceil(F.lit(float(settings.val_ratio)) * F.col("_n_tv")))
    q = _largest_remainder(q, "q_tv", "_n_tr", "_n_tv", "q_train", intent)
    return q.select(intent, "c", "q_tv", "q_train")


def stratified_split(df: DataFrame, settings: Settings = DEFAULT, intent: str = "intent") -> DataFrame:
    """Adds ``split`` (train / val / test); rare and null intents are removed.

    Plan: the input is read twice.  First pass: rows per (intent, md5 bucket)
    with partial aggregation; the intent counts, quotas and bucket offsets are
    all derived from that table.  Second pass: one shuffle of the data on
    (intent, bucket) joined with the offsets, then ``row_number`` inside
    each bucket gives the exact rank within the intent.
    """
    kept = df.where(F.col(intent).isNotNull()).withColumn(
        "_key", seeded_key("row_id", settings.random_seed)
    ).withColumn("_bucket", hash_bucket("_key", settings.rank_bucket_hex_digits))
    path = scratch_path(df.sparkSession, "split_offsets")
    bucket_offsets(kept, [intent]).write.parquet(path)
    offsets = df.sparkSession.read.parquet(path)
    counts = offsets.groupBy(intent).agg(F.sum("_n").cast("bigint").alias("c"))
    quotas = split_quotas(counts.where(F.col("c") >= settings.rare_threshold), settings, intent)
    table = offsets.join(quotas.select(intent, "q_tv", "q_train"), intent)
    ranked = rank_with_offsets(kept, table, [intent], ["_key", "row_id"], rank_col="_rank")
    split = (
        F.when(F.col("_rank") <= F.col("q_train"), F.lit("train"))
        .when(F.col("_rank") <= F.col("q_tv"), F.lit("val"))
        .otherwise(F.lit("test"))
    )
    return ranked.select(*df.columns, split.alias("split"))


def intent_stats(splits: DataFrame, intent: str = "intent") -> DataFrame:
    """Rows per (split, intent)."""
    return splits.groupBy("split", intent).agg(F.count(F.lit(1)).alias("n"))


def intent_inventory(splits: DataFrame, intent: str = "intent") -> DataFrame:
    """Distinct intents of train, their number and the sorted list.

    Distinct intents are found with a partial aggregation first, so only one
    row per intent reaches the final list.
    """
    distinct = splits.where(F.col("split") == "train").select(intent).distinct()
    return distinct.agg(
        F.count(F.lit(1)).alias("total_intents"),
        F.array_join(F.sort_array(F.collect_list(intent)), ",").alias("intent_list"),
    )


def split_sizes(splits: DataFrame) -> DataFrame:
    """Rows and percent of all rows per split."""
    per = splits.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(F.lit(0))
    return per.select(
        "split",
        "n",
        (F.col("n").cast("double") * 100.0 / F.sum("n").over(whole)).alias("pct"),
    )
