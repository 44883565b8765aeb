"""Registered queries: rare filter, exact split, split statistics, split sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from parlance.config import scratch_path
from parlance.operators import splits as sp
from parlance.plans.oracle_sql import with_views
from parlance.plans.registry import register, rounded
from parlance.sources import tables, views


def stored_splits(spark, sf_dir):
    """The split (W2) as a stored table: computed once, read by all that use it."""
    return views.written(spark, sf_dir, "splits", lambda: sp.stratified_split(views.pairs(spark, sf_dir)))


def stored_membership(spark, sf_dir):
    """``row_id, intent, split``: the split (W2) without the texts, bucketed like the stored outputs, to be joined with them."""
    return views.written(
        spark, sf_dir, "membership", lambda: sp.stratified_split(views.utterances(spark, sf_dir).select("row_id", "intent")), "row_id"
    )


@register(
    "filter_rare_intents",
    with_views(
        "SELECT intent FROM pairs WHERE intent IS NOT NULL GROUP BY intent HAVING count(*) < 3",
        "pairs",
    ),
)
def q_filter_rare_intents(spark, sf_dir):
    """intents with fewer than three rows."""
    return sp.rare_intents(views.pairs(spark, sf_dir))


@register(
    "anti_join_rare",
    with_views(
        "SELECT row_id, intent FROM pairs WHERE intent IS NOT NULL AND intent NOT IN "
        "(SELECT intent FROM pairs WHERE intent IS NOT NULL GROUP BY intent HAVING count(*) < 3)",
        "pairs",
    ),
)
def q_anti_join_rare(spark, sf_dir):
    """Rows whose intent is not rare."""
    return sp.anti_join_rare(views.pairs(spark, sf_dir)).select("row_id", "intent")


@register("split_quotas", with_views("SELECT * FROM split_quotas", "split_quotas"))
def q_split_quotas(spark, sf_dir):
    """W2 sizes: per intent count, train+val quota and train quota."""
    kept = views.pairs(spark, sf_dir)
    counts = sp.intent_counts(kept).where(F.col("c") >= 3)
    return sp.split_quotas(counts)


@register("stratified_split", with_views("SELECT row_id, intent, split FROM splits", "splits"))
def q_stratified_split(spark, sf_dir):
    """Exact, seeded, intent-stratified train / val / test."""
    return sp.stratified_split(views.pairs(spark, sf_dir)).select("row_id", "intent", "split")


@register(
    "intent_stats",
    with_views("SELECT split, intent, count(*) AS n FROM splits GROUP BY split, intent", "splits"),
)
def q_intent_stats(spark, sf_dir):
    """Rows per split and intent."""
    return sp.intent_stats(stored_splits(spark, sf_dir))


@register(
    "intent_inventory",
    with_views(
        "SELECT count(*) AS total_intents, string_agg(intent, ',' ORDER BY intent) AS intent_list "
        "FROM (SELECT DISTINCT intent FROM splits WHERE split = 'train') d",
        "splits",
    ),
)
def q_intent_inventory(spark, sf_dir):
    """Number and sorted list of train intents."""
    return sp.intent_inventory(stored_splits(spark, sf_dir))


@register(
    "split_sizes",
    with_views(
        "SELECT split, count(*) AS n, round(CAST(count(*) AS DOUBLE) * 100.0 / sum(count(*)) OVER (), 6) AS pct "
        "FROM splits GROUP BY split",
        "splits",
    ),
)
def q_split_sizes(spark, sf_dir):
    """Rows and percent per split."""
    return rounded(sp.split_sizes(stored_splits(spark, sf_dir)))


@register(
    "scan_split_partition",
    with_views("SELECT row_id, intent, params, output_text, split FROM splits WHERE split = 'val'", "splits"),
)
def q_scan_split_partition(spark, sf_dir):
    """S3 over S4: write the splits partitioned by split, read back only ``val``."""
    root = scratch_path(spark, "splits")
    tables.sink_splits(stored_splits(spark, sf_dir), root)
    return tables.scan_split_partition(spark, root, "val").select(
        "row_id", "intent", "params", "output_text", "split"
    )


@register(
    "sink_splits_csv",
    with_views("SELECT row_id, transcript, intent, params, input_text, output_text, frequency, split FROM splits", "splits"),
)
def q_sink_splits_csv(spark, sf_dir):
    """S4 + S2: CSV splits (JSON inside quoted cells) survive a round trip."""
    root = scratch_path(spark, "splits_csv")
    tables.sink_splits(stored_splits(spark, sf_dir), root, fmt="csv")
    parts = [tables.scan_split_csv(spark, f"{root}/split={s}").withColumn("split", F.lit(s)) for s in ("train", "val", "test")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
