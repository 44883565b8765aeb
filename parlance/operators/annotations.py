"""Annotation parsing and training-pair formatting.

The annotation cell is a JSON text whose first list element holds the
intent ``id`` and the ``params`` object.  All parsing is done with built-in
expressions inside one projection: no UDF, no shuffle.

Semantics kept from the original project:

* P1: only a strict JSON *list* with at least one element yields an element;
  bad JSON, an object, an empty list or a null cell yield ``{}``.
* P2: ``params`` defaults to ``{}`` only when the key is missing; an explicit
  JSON null stays ``null``.
* A first element that is not an object (``[5]``, ``[null]``) made the
  original stop; here it gives ``{}`` and the row is flagged
  (``bad_element``) for quarantine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions.json import json_quote, strict_json, variant_kind


ANNOTATION_COLUMNS = (
    "a_valid", "a_is_list", "a_elem", "a_elem_object", "a_has_params",
    "a_params_kind", "a_params", "a_has_id", "a_ann_id",
)


def annotate(df: DataFrame, nli: str = "nli_output", keep_variant: bool = False) -> DataFrame:
    """Add the facts of one annotation cell as ``a_*`` columns.

    ``a_valid``        strict JSON
    ``a_is_list``      valid, top level is a non-empty list (F3)
    ``a_elem``         text of the first element (null unless ``a_is_list``)
    ``a_elem_object``  first element is a JSON object
    ``a_has_params``   that object has a ``params`` key
    ``a_params_kind``  OBJECT ARRAY STRING INT FLOAT BOOLEAN NULL of ``params``
    ``a_params``       JSON text of ``params`` per P2 (never null)
    ``a_has_id``/``a_ann_id``  the element's ``id`` key and its text

    With ``keep_variant`` the parsed params stay as VARIANT ``a_params_v``
    (null unless ``a_has_params``).

    Built in stages so that each parse happens once per row and every later
    expression refers to a column instead of repeating the parse.
    """
    c = F.col(nli)
    staged = df.withColumns(
        {
            "a_valid": strict_json(c),
            "_a_var": F.try_parse_json(c),
        }
    ).withColumns(
        {
            "a_is_list": F.col("a_valid")
            & F.ltrim(c).startswith("[")
            & (F.coalesce(F.json_array_length(c), F.lit(0)) > 0),
            "_a_first": F.try_variant_get("_a_var", "$[0]", "variant"),
        }
    ).withColumns(
        {
            "a_elem": F.when(F.col("a_is_list"), F.get(F.from_json(c, "array<string>"), 0)),
            "_a_first_kind": variant_kind("_a_first"),
        }
    ).withColumns(
        {
            "a_elem_object": F.col("a_is_list") & F.coalesce(F.col("_a_first_kind") == "OBJECT", F.lit(False)),
            "_a_keys": F.json_object_keys("a_elem"),
        }
    ).withColumns(
        {
            "a_has_params": F.col("a_elem_object") & F.coalesce(F.array_contains("_a_keys", "params"), F.lit(False)),
            "a_has_id": F.col("a_elem_object") & F.coalesce(F.array_contains("_a_keys", "id"), F.lit(False)),
            "_a_members": F.from_json("a_elem", "struct<id:string,params:string>"),
        }
    ).withColumns(
        {
            "a_params_kind": F.when(
                F.col("a_has_params"), variant_kind(F.try_variant_get("_a_first", "$.params", "variant"))
            ),
            "a_ann_id": F.when(F.col("a_has_id"), F.col("_a_members.id")),
        }
    )
    raw = F.col("_a_members.params")
    params = (
        F.when(~F.col("a_has_params"), F.lit("{}"))
        .when(F.col("a_params_kind") == "NULL", F.lit("null"))
        .when(F.col("a_params_kind") == "STRING", json_quote(raw))
        .otherwise(raw)
    )
    out = staged.withColumn("a_params", params)
    if keep_variant:
        out = out.withColumn(
            "a_params_v", F.when(F.col("a_has_params"), F.try_variant_get("_a_first", "$.params", "variant"))
        )
    return out.drop("_a_var", "_a_first", "_a_first_kind", "_a_keys", "_a_members")


def parse_annotation(df: DataFrame, nli: str = "nli_output") -> DataFrame:
    """Adds ``elem`` (first element text, ``{}`` when there is none)."""
    a = annotate(df, nli)
    return a.withColumn(
        "elem", F.when(F.col("a_elem_object"), F.col("a_elem")).otherwise(F.lit("{}"))
    ).drop(*ANNOTATION_COLUMNS)


def extract_params(df: DataFrame, nli: str = "nli_output") -> DataFrame:
    """Adds ``params`` as JSON text."""
    return annotate(df, nli).withColumn("params", F.col("a_params")).drop(*ANNOTATION_COLUMNS)


def format_input(transcript) -> Column:
    """``nlu: <transcript>``."""
    t = F.col(transcript) if isinstance(transcript, str) else transcript
    return F.concat(F.lit("nlu: "), t)


def format_target(intent, params_json) -> Column:
    """Compact JSON ``{"intent":...,"params":...}``, key order and non-ASCII kept."""
    i = F.col(intent) if isinstance(intent, str) else intent
    p = F.col(params_json) if isinstance(params_json, str) else params_json
    return F.concat(F.lit('{"intent":'), json_quote(i), F.lit(',"params":'), p, F.lit("}"))


def preprocess(utt: DataFrame) -> DataFrame:
    """P5 (flagship): raw utterances -> training pairs, one projection.

    Output: ``row_id, transcript, intent, params, input_text, output_text,
    frequency``.  Narrow transformation only: it runs where the scan runs.
    """
    a = annotate(utt, "nli_output")
    return a.select(
        "row_id",
        "transcript",
        "intent",
        F.col("a_params").alias("params"),
        format_input("transcript").alias("input_text"),
        format_target("intent", "a_params").alias("output_text"),
        "frequency",
    )


def annotation_intent_id(df: DataFrame, nli: str = "nli_output", intent: str = "intent") -> DataFrame:
    """The annotation's ``id`` when the key exists, else the intent column."""
    a = annotate(df, nli)
    return a.withColumn(
        "ann_intent", F.when(F.col("a_has_id"), F.col("a_ann_id")).otherwise(F.col(intent))
    ).drop(*ANNOTATION_COLUMNS)


def filter_valid_annotation(df: DataFrame, nli: str = "nli_output") -> DataFrame:
    """rows whose annotation is a JSON list with at least one element."""
    return annotate(df, nli).where(F.col("a_is_list")).drop(*ANNOTATION_COLUMNS)


def params_flag() -> Column:
    """F4 over :func:`annotate` columns: ``with`` / ``without`` / null.

    Strict list with elements: its first element's params decide (a non-object
    element or falsy params count as ``without``).  Unparseable text counts as
    ``without``.  Valid JSON that is not a non-empty list is not counted.
    """
    k = F.col("a_params_kind")
    p = F.col("a_params")
    truthy = (
        F.when(k == "OBJECT", p != "{}")
        .when(k == "ARRAY", p != "[]")
        .when(k == "STRING", p != '""')
        .when(k.isin("INT", "FLOAT"), F.coalesce(p.try_cast("double") != 0, F.lit(True)))
        .when(k == "BOOLEAN", p == "true")
        .otherwise(F.lit(False))
    )
    return (
        F.when(~F.col("a_valid"), F.lit("without"))
        .when(~F.col("a_is_list"), F.lit(None))
        .when(F.col("a_has_params") & truthy, F.lit("with"))
        .otherwise(F.lit("without"))
    )


def quarantine_bad_rows(df: DataFrame, nli: str = "nli_output") -> DataFrame:
    """F8: rows whose annotation could not be used, with the reason.

    ``bad_json`` (not strict JSON), ``bad_element`` (first element of a list
    is not an object) and ``bad_params`` (its ``params`` is not an object).  The caller decides how many to show (the
    original printed those among the first five rows).
    """
    a = annotate(df, nli)
    reason = (
        F.when(~F.col("a_valid"), F.lit("bad_json"))
        .when(F.col("a_is_list") & ~F.col("a_elem_object"), F.lit("bad_element"))
        .when(F.col("a_has_params") & (F.col("a_params_kind") != "OBJECT"), F.lit("bad_params"))
    )
    return a.withColumn("reason", reason).where(F.col("reason").isNotNull()).drop(*ANNOTATION_COLUMNS)
