"""Registered queries: sources, annotation parsing, training pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from parlance.config import scratch_path
from parlance.operators import annotations as ann
from parlance.plans.oracle_sql import with_views
from parlance.plans.registry import register
from parlance.sources import tables, views


@register(
    "preprocess",
    with_views("SELECT * FROM pairs", "pairs"),
)
def q_preprocess(spark, sf_dir):
    """P5: raw utterances to training pairs (flagship)."""
    return views.pairs(spark, sf_dir)


@register(
    "scan_utterances",
    with_views("SELECT * FROM utterances", "utterances"),
)
def q_scan_utterances(spark, sf_dir):
    """Write the raw table once, read it back with the fixed schema."""
    path = scratch_path(spark, "utterances")
    views.utterances(spark, sf_dir).write.mode("overwrite").parquet(path)
    return tables.scan_utterances(spark, path)


@register(
    "parse_annotation",
    with_views(
        "SELECT row_id, CASE WHEN elem_object THEN CAST(elem AS VARCHAR) ELSE '{}' END AS elem FROM annotated",
        "annotated",
    ),
)
def q_parse_annotation(spark, sf_dir):
    """First list element of the annotation, ``{}`` otherwise."""
    return ann.parse_annotation(views.utterances(spark, sf_dir)).select("row_id", "elem")


@register(
    "extract_params",
    with_views("SELECT row_id, params FROM annotated", "annotated"),
)
def q_extract_params(spark, sf_dir):
    """Params text, ``{}`` only when the key is missing."""
    return ann.extract_params(views.utterances(spark, sf_dir)).select("row_id", "params")


@register(
    "format_input",
    with_views("SELECT row_id, input_text FROM pairs", "pairs"),
)
def q_format_input(spark, sf_dir):
    """Model input text."""
    u = views.utterances(spark, sf_dir)
    return u.select("row_id", ann.format_input("transcript").alias("input_text"))


@register(
    "format_target",
    with_views("SELECT row_id, output_text FROM pairs", "pairs"),
)
def q_format_target(spark, sf_dir):
    """Model target text."""
    return views.pairs(spark, sf_dir).select("row_id", "output_text")


@register(
    "annotation_intent_id",
    with_views(
        "SELECT row_id, CASE WHEN has_id THEN ann_id ELSE intent END AS ann_intent "
        "FROM annotated WHERE is_list AND elem_object",
        "annotated",
    ),
)
def q_annotation_intent_id(spark, sf_dir):
    """Annotation id, else the intent column (rows with a usable element)."""
    a = ann.annotate(views.utterances(spark, sf_dir))
    return (
        a.where("a_elem_object")
        .withColumn("ann_intent", F.when(F.col("a_has_id"), F.col("a_ann_id")).otherwise(F.col("intent")))
        .select("row_id", "ann_intent")
    )


@register(
    "filter_valid_annotation",
    with_views("SELECT row_id, intent FROM annotated WHERE is_list", "annotated"),
)
def q_filter_valid_annotation(spark, sf_dir):
    """rows with a non-empty JSON list."""
    return ann.filter_valid_annotation(views.utterances(spark, sf_dir)).select("row_id", "intent")


F4_SQL = with_views(
    r"""
SELECT row_id,
  CASE WHEN NOT valid THEN 'without'
       WHEN NOT is_list THEN NULL
       WHEN has_params AND CASE params_type
            WHEN 'OBJECT' THEN params <> '{}'
            WHEN 'ARRAY' THEN params <> '[]'
            WHEN 'VARCHAR' THEN params <> '""'
            WHEN 'BOOLEAN' THEN params = 'true'
            WHEN 'NULL' THEN false
            ELSE coalesce(TRY_CAST(params AS DOUBLE) <> 0, true) END
       THEN 'with' ELSE 'without' END AS params_flag
FROM annotated
""",
    "annotated",
)


@register("has_params_flag", F4_SQL)
def q_has_params_flag(spark, sf_dir):
    """with / without / not counted."""
    a = ann.annotate(views.utterances(spark, sf_dir))
    return a.select("row_id", ann.params_flag().alias("params_flag"))


@register(
    "quarantine_bad_rows",
    with_views(
        "SELECT row_id, CASE WHEN NOT valid THEN 'bad_json' WHEN is_list AND NOT elem_object THEN 'bad_element' ELSE 'bad_params' END AS reason "
        "FROM annotated WHERE NOT valid OR (is_list AND NOT elem_object) OR (has_params AND params_type <> 'OBJECT')",
        "annotated",
    ),
)
def q_quarantine_bad_rows(spark, sf_dir):
    """F8: every unusable annotation with its reason."""
    return ann.quarantine_bad_rows(views.utterances(spark, sf_dir)).select("row_id", "reason")


@register(
    "quarantine_first_rows",
    with_views(
        "SELECT row_id, CASE WHEN NOT valid THEN 'bad_json' WHEN is_list AND NOT elem_object THEN 'bad_element' ELSE 'bad_params' END AS reason "
        "FROM annotated WHERE (NOT valid OR (is_list AND NOT elem_object) OR (has_params AND params_type <> 'OBJECT')) AND row_id < 5",
        "annotated",
    ),
)
def q_quarantine_first_rows(spark, sf_dir):
    """F8 as the original reported it: bad rows among the first five positions."""
    bad = ann.quarantine_bad_rows(views.utterances(spark, sf_dir))
    return bad.where(F.col("row_id") < 5).select("row_id", "reason")
