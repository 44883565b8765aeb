"""Registered queries: output parsing, repair and response shaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from parlance.operators import outputs as out
from parlance.plans.oracle_sql import parse_single_sql, with_views
from parlance.plans.registry import register
from parlance.sources import views

TRUNCATED_SQL = "SELECT row_id, regexp_replace(output_text, '^\\{|\\}+$', '', 'g') AS raw FROM pairs"
SINGLE = parse_single_sql("predictions", "pred_text")
SINGLE_TRUNC = parse_single_sql("truncated", "raw")


def _single(spark, sf_dir):
    return out.parse_outputs(views.predictions(spark, sf_dir), "pred_text", "single")


def _single_trunc(spark, sf_dir):
    return out.parse_outputs(views.truncated_outputs(spark, sf_dir), "raw", "single")


@register(
    "parse_outputs_single",
    with_views(f"SELECT row_id, settled_by, intent, params, raw_output, error FROM ({SINGLE}) s", "predictions"),
)
def q_parse_outputs_single(spark, sf_dir):
    """P13-P16 single mode over the model outputs."""
    return _single(spark, sf_dir).select("row_id", "settled_by", "intent", "params", "raw_output", "error")


@register(
    "parse_outputs_batch",
    with_views(
        """SELECT row_id,
  CASE WHEN j IS NULL THEN 'sentinel' ELSE 'strict' END AS settled_by,
  CASE WHEN j IS NULL THEN 'UNSUPPORTED' WHEN json_type(j) = 'OBJECT' THEN json_extract_string(j, '$.intent') END AS intent,
  CASE WHEN j IS NULL THEN '{}' WHEN json_type(j) = 'OBJECT' THEN CAST(json_extract(j, '$.params') AS VARCHAR) END AS params,
  CASE WHEN j IS NULL THEN pred_text END AS raw_output
FROM (SELECT row_id, pred_text, TRY_CAST(pred_text AS JSON) AS j FROM predictions) p""",
        "predictions",
    ),
)
def q_parse_outputs_batch(spark, sf_dir):
    """P16 batch mode: no repair, ``UNSUPPORTED`` with the raw text."""
    p = out.parse_outputs(views.predictions(spark, sf_dir), "pred_text", "batch")
    return p.select("row_id", "settled_by", "intent", "params", "raw_output")


@register(
    "parse_output_intent_fallback",
    with_views(
        """SELECT row_id,
  CASE WHEN j IS NULL THEN coalesce(nullif(regexp_extract(pred_text, '"intent":\\s*"([^"]+)"', 1), ''), 'PARSE_ERROR')
       WHEN json_type(j) = 'OBJECT' THEN CASE WHEN json_extract(j, '$.intent') IS NULL THEN 'N/A' ELSE json_extract_string(j, '$.intent') END END AS intent,
  CASE WHEN j IS NULL THEN '{}' WHEN json_type(j) = 'OBJECT' THEN coalesce(CAST(json_extract(j, '$.params') AS VARCHAR), '{}') END AS params,
  pred_text AS raw_output, CASE WHEN j IS NULL THEN 'invalid JSON' END AS error
FROM (SELECT row_id, pred_text, TRY_CAST(pred_text AS JSON) AS j FROM predictions) p""",
        "predictions",
    ),
)
def q_parse_output_intent_fallback(spark, sf_dir):
    """Strict parse, else the intent by pattern or ``PARSE_ERROR``."""
    p = out.parse_outputs(views.predictions(spark, sf_dir), "pred_text", "fallback")
    return p.select("row_id", "intent", "params", "raw_output", "error")


INTENT_ONLY_SQL = "SELECT row_id, '\"intent\":' || CAST(to_json(intent) AS VARCHAR) AS raw FROM pairs"


@register(
    "repair_outer_braces",
    with_views(
        f"SELECT row_id, settled_by, result FROM ({parse_single_sql('intent_only', 'raw')}) s",
        "pairs",
        extra={"intent_only": INTENT_ONLY_SQL},
    ),
)
def q_repair_outer_braces(spark, sf_dir):
    """Intent-only outputs without braces, settled by adding them."""
    p = out.parse_outputs(views.intent_only_outputs(spark, sf_dir), "raw", "single")
    return p.select("row_id", "settled_by", "result")


@register(
    "repair_regex_params",
    with_views(
        f"SELECT row_id, result FROM ({SINGLE_TRUNC}) s WHERE settled_by = 'regex'",
        "pairs",
        extra={"truncated": TRUNCATED_SQL},
    ),
)
def q_repair_regex_params(spark, sf_dir):
    """Truncated outputs settled by the intent/params patterns."""
    return _single_trunc(spark, sf_dir).where(F.col("settled_by") == "regex").select("row_id", "result")


_KNOWN = " ".join("WHEN {} THEN '{}'".format(i, params.replace("'", "''")) for i, (_, params) in enumerate(views.CORRUPTED))
CORRUPTED_SQL = f"""
SELECT event_id AS row_id, 'scan' AS settled_by, upper(event_type) AS intent,
  replace(replace(replace(CASE event_id % {len(views.CORRUPTED)} {_KNOWN} END, '{{n}}', regexp_extract(props, '([0-9]+)', 1)),
    '{{t}}', event_type), '{{c}}', substr(event_type, 1, 3)) AS params
FROM events
"""


@register("repair_scan_params", CORRUPTED_SQL)
def q_repair_scan_params(spark, sf_dir):
    """Outputs of every kind of damage, which only the last-resort scanner reads; the answers are known by construction."""
    parsed = out.parse_outputs(views.corrupted_outputs(spark, sf_dir), "raw", "single")
    return parsed.select("row_id", "settled_by", "intent", "params")


@register(
    "output_sentinel",
    with_views(
        f"SELECT row_id, intent, raw_output, error FROM ({SINGLE}) s WHERE settled_by = 'sentinel'",
        "predictions",
    ),
)
def q_output_sentinel(spark, sf_dir):
    """Outputs that end as the ``PARSE_ERROR`` sentinel."""
    s = _single(spark, sf_dir)
    return s.where(F.col("settled_by") == "sentinel").select("row_id", "intent", "raw_output", "error")


_PMAP_VALUE = (
    "CASE e.type WHEN 'VARCHAR' THEN json_extract_string(e.value, '$') "
    "WHEN 'BOOLEAN' THEN CASE WHEN CAST(e.value AS BOOLEAN) THEN 'True' ELSE 'False' END "
    "WHEN 'NULL' THEN 'None' ELSE CAST(e.value AS VARCHAR) END"
)
PMAP = f"""
SELECT s.row_id, e.key, {_PMAP_VALUE} AS value
FROM ({SINGLE}) s, json_each(CAST(s.params AS JSON)) e
WHERE s.is_object AND json_type(CAST(s.params AS JSON)) = 'OBJECT'
"""


def _pmap_rows(spark, sf_dir):
    s = _single(spark, sf_dir)
    m = out.params_to_string_map(F.col("params"))
    return s.where(F.col("is_object")).select("row_id", F.explode(m).alias("key", "value"))


@register("params_to_string_map", with_views(PMAP, "predictions"))
def q_params_to_string_map(spark, sf_dir):
    """P10: params as a string map, one row per entry."""
    return _pmap_rows(spark, sf_dir)


@register(
    "retype_string_params",
    with_views(
        f"SELECT row_id, key, CASE WHEN json_valid(value) THEN value ELSE CAST(to_json(value) AS VARCHAR) END AS value_json "
        f"FROM ({PMAP}) m",
        "predictions",
    ),
)
def q_retype_string_params(spark, sf_dir):
    """Map values back to JSON (parsed when they parse, else strings)."""
    s = _single(spark, sf_dir).where(F.col("is_object"))
    m = out.retype_string_params(out.params_to_string_map(F.col("params")))
    return s.select("row_id", F.explode(m).alias("key", "value_json"))


@register(
    "response_record",
    with_views(
        f"""
SELECT s.row_id,
  CASE WHEN NOT s.is_object THEN 'ERROR' WHEN NOT s.has_intent THEN 'UNKNOWN' ELSE coalesce(s.intent, '') END AS resp_intent,
  coalesce(m.params_text, '') AS params_text,
  coalesce(m.n_params, 0) AS n_params,
  s.raw_output,
  CASE WHEN NOT s.is_object THEN 'result is not an object' ELSE s.error END AS error,
  CAST(CASE WHEN s.is_object THEN e.value ELSE 0.0 END AS FLOAT) AS inference_time_ms
FROM ({SINGLE}) s
LEFT JOIN (SELECT row_id, string_agg(key || '=' || value, ';' ORDER BY key || '=' || value) AS params_text,
                  count(*) AS n_params FROM ({PMAP}) p GROUP BY row_id) m ON s.row_id = m.row_id
JOIN events e ON e.event_id = s.row_id
""",
        "predictions",
    ),
)
def q_response_record(spark, sf_dir):
    """The response record of every output, with its measured time."""
    s = _single(spark, sf_dir)
    lat = views.latencies(spark, sf_dir).select("row_id", "inference_time_ms")
    r = out.response_record(s.join(lat, "row_id"), F.col("inference_time_ms"))
    return r.select(
        "row_id",
        "resp_intent",
        out.map_as_text(F.col("resp_params")).alias("params_text"),
        F.size("resp_params").cast("bigint").alias("n_params"),
        F.col("resp_raw_output").alias("raw_output"),
        F.col("resp_error").alias("error"),
        "inference_time_ms",
    )


TEXTS_SQL = (
    "SELECT doc_id AS row_id, text FROM documents UNION ALL "
    "SELECT -(conv_id * 1000 + turn) - 1 AS row_id, text FROM conversations"
)


@register(
    "drop_blank_utterances",
    with_views(
        "SELECT row_id FROM texts WHERE NOT regexp_matches(text, '^[\\x09-\\x0D\\x1C-\\x20\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]*$')",
        extra={"texts": TEXTS_SQL},
    ),
)
def q_drop_blank_utterances(spark, sf_dir):
    """texts that are not blank."""
    return out.drop_blank_utterances(views.texts(spark, sf_dir)).select("row_id")


CLASSIFIED = f"""
SELECT s.row_id,
  CASE WHEN s.raw_output IS NOT NULL OR s.error IS NOT NULL OR NOT s.is_object THEN 'json_parse_error'
       WHEN (CASE WHEN s.has_intent THEN s.intent ELSE 'UNKNOWN' END) IN ('UNSUPPORTED', 'PARSE_ERROR', 'UNKNOWN') THEN 'wrong_intent'
       WHEN (s.params IS NULL OR s.params IN ('{{}}', '[]', '""', 'null', 'false') OR regexp_matches(s.params, '^-?0+(\\.0*)?([eE][+-]?[0-9]+)?$'))
            AND contains(lower(u.transcript), 'timer') THEN 'missing_params'
       ELSE 'ok' END AS issue
FROM ({SINGLE}) s JOIN utterances u ON s.row_id = u.row_id
"""


def _classified(spark, sf_dir):
    s = _single(spark, sf_dir)
    u = views.utterances(spark, sf_dir).select("row_id", "transcript")
    return out.classify_output_issue(s.join(u, "row_id"))


@register("classify_output_issue", with_views(CLASSIFIED, "predictions", "utterances"))
def q_classify_output_issue(spark, sf_dir):
    """issue kind of every output."""
    return _classified(spark, sf_dir).select("row_id", "issue")


@register(
    "issue_summary",
    with_views(
        f"""SELECT k.issue, CAST(coalesce(c.n, 0) AS BIGINT) AS n,
       round(CAST(coalesce(c.n, 0) AS DOUBLE) * 100.0 / t.total, 6) AS pct
FROM (VALUES ('json_parse_error'), ('wrong_intent'), ('missing_params'), ('ok')) k(issue)
LEFT JOIN (SELECT issue, count(*) AS n FROM ({CLASSIFIED}) x GROUP BY issue) c ON k.issue = c.issue,
(SELECT count(*) AS total FROM ({CLASSIFIED}) y) t""",
        "predictions", "utterances",
    ),
)
def q_issue_summary(spark, sf_dir):
    """Count and percent per issue kind."""
    return out.issue_summary(_classified(spark, sf_dir)).withColumn("pct", F.round("pct", 6))


def _requests(spark, sf_dir):
    """Batch requests of 16 utterances each (bounded groups)."""
    u = views.utterances(spark, sf_dir).select("row_id", "transcript")
    return u.groupBy(F.expr("row_id div 16").alias("request_id")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("row_id", "transcript"))), lambda s: s["transcript"]).alias("texts"),
        F.array_sort(F.collect_list("row_id")).alias("row_ids"),
    )


@register(
    "ingest_text_batch",
    with_views(
        "SELECT row_id // 16 AS request_id, "
        "CAST(row_number() OVER (PARTITION BY row_id // 16 ORDER BY row_id) - 1 AS INTEGER) AS position, "
        "transcript AS text FROM utterances",
        "utterances",
    ),
)
def q_ingest_text_batch(spark, sf_dir):
    """A request's list of texts to one row per text with its position."""
    from parlance.sources.tables import ingest_text_batch

    return ingest_text_batch(_requests(spark, sf_dir).select("request_id", "texts"))


@register(
    "zip_texts_with_predictions",
    with_views(
        "SELECT u.row_id // 16 AS request_id, "
        "CAST(row_number() OVER (PARTITION BY u.row_id // 16 ORDER BY u.row_id) - 1 AS INTEGER) AS position, "
        "u.transcript AS text, CASE WHEN j IS NULL THEN 'UNSUPPORTED' WHEN json_type(j) = 'OBJECT' "
        "THEN coalesce(json_extract_string(j, '$.intent'), '') ELSE 'ERROR' END AS intent "
        "FROM utterances u JOIN (SELECT row_id, TRY_CAST(pred_text AS JSON) AS j FROM predictions) p ON u.row_id = p.row_id",
        "utterances", "predictions",
    ),
)
def q_zip_texts_with_predictions(spark, sf_dir):
    """Request texts and batch responses matched by position."""
    req = _requests(spark, sf_dir)
    batch = out.parse_outputs(views.predictions(spark, sf_dir), "pred_text", "batch")
    intent = (
        F.when(F.col("settled_by") == "sentinel", F.col("intent"))
        .when(~F.col("is_object"), F.lit(out.ERROR))
        .otherwise(F.coalesce(F.col("intent"), F.lit("")))
    )
    resp = batch.select(F.expr("row_id div 16").alias("request_id"), "row_id", intent.alias("intent"))
    responses = resp.groupBy("request_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("row_id", "intent"))), lambda s: s["intent"]).alias("predictions")
    )
    z = out.zip_texts_with_predictions(req, responses)
    return z.select("request_id", "position", "text", F.col("prediction").alias("intent"))


