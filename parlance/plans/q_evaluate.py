"""Registered queries: evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from parlance.operators import evaluate as ev
from parlance.plans.oracle_sql import eligible_sql, flat_sql, with_views
from parlance.plans.registry import register, rounded
from parlance.sources import views


def _aligned(spark, sf_dir):
    pred = views.predictions(spark, sf_dir)
    ref = views.references(spark, sf_dir).select("row_id", "ref_text")
    return ev.align_predictions(pred, ref)


def _pct_sql(cond: str, name: str) -> str:
    return f"round(avg(CASE WHEN {cond} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) * 100.0, 6) AS {name}"


@register(
    "extract_pred_intent",
    with_views("SELECT row_id, intent_pred FROM aligned", "aligned"),
)
def q_extract_pred_intent(spark, sf_dir):
    """Strict intent of every prediction."""
    pred = views.predictions(spark, sf_dir)
    return pred.select("row_id", ev.extract_pred_intent("pred_text").alias("intent_pred"))


@register(
    "extract_ref_intent",
    with_views("SELECT row_id, intent_true FROM aligned", "aligned"),
)
def q_extract_ref_intent(spark, sf_dir):
    """Intent of every reference."""
    ref = views.references(spark, sf_dir)
    return ref.select("row_id", ev.extract_ref_intent("ref_text").alias("intent_true"))


@register("align_predictions", with_views("SELECT * FROM aligned", "aligned"))
def q_align_predictions(spark, sf_dir):
    """Predictions joined with references on row_id."""
    return _aligned(spark, sf_dir).select("row_id", "pred_text", "ref_text", "intent_pred", "intent_true")


@register(
    "exact_match",
    with_views(f"SELECT {_pct_sql('coalesce(pred_text = ref_text, false)', 'exact_match')} FROM aligned", "aligned"),
)
def q_exact_match(spark, sf_dir):
    """Percent identical texts."""
    return rounded(_aligned(spark, sf_dir).agg(ev.exact_match()))


@register(
    "intent_accuracy",
    with_views(
        f"SELECT {_pct_sql('intent_pred IS NOT DISTINCT FROM intent_true', 'intent_accuracy')} FROM aligned",
        "aligned",
    ),
)
def q_intent_accuracy(spark, sf_dir):
    """Percent equal intents."""
    return rounded(_aligned(spark, sf_dir).agg(ev.intent_accuracy()))


@register(
    "parse_success_rate",
    with_views(
        "SELECT " + _pct_sql("intent_pred IS DISTINCT FROM 'PARSE_ERROR'", "parse_success_rate") + " FROM aligned",
        "aligned",
    ),
)
def q_parse_success_rate(spark, sf_dir):
    """Percent parseable predictions."""
    return rounded(_aligned(spark, sf_dir).agg(ev.parse_success_rate()))


PER_INTENT = f"""
SELECT intent_true,
       CAST(sum(CASE WHEN intent_pred IS NOT DISTINCT FROM intent_true THEN 1 ELSE 0 END) AS BIGINT) AS correct,
       count(*) AS total,
       {_pct_sql('intent_pred IS NOT DISTINCT FROM intent_true', 'accuracy')}
FROM aligned GROUP BY intent_true
"""


@register("per_intent_accuracy", with_views(PER_INTENT, "aligned"))
def q_per_intent_accuracy(spark, sf_dir):
    """Correct / total / accuracy per true intent."""
    return rounded(ev.per_intent_accuracy(_aligned(spark, sf_dir)))


@register(
    "top_intent_accuracy",
    with_views(f"SELECT * FROM ({PER_INTENT}) x ORDER BY total DESC, intent_true LIMIT 10", "aligned"),
)
def q_top_intent_accuracy(spark, sf_dir):
    """K5: ten largest intents with their accuracy."""
    return rounded(ev.top_intent_accuracy(ev.per_intent_accuracy(_aligned(spark, sf_dir))))


@register(
    "bottom_intent_accuracy",
    with_views(f"SELECT * FROM ({PER_INTENT}) x ORDER BY CAST(correct AS DOUBLE) / total, intent_true LIMIT 5", "aligned"),
)
def q_bottom_intent_accuracy(spark, sf_dir):
    """K6: five least accurate intents."""
    return rounded(ev.bottom_intent_accuracy(ev.per_intent_accuracy(_aligned(spark, sf_dir))))


@register("flatten_params", with_views(f"SELECT row_id, path, kind, vkey FROM ({flat_sql('rv', 'all_refs')}) x", "aligned", extra={"all_refs": eligible_sql("ref_text", "rv")}))
def q_flatten_params(spark, sf_dir):
    """Flattened params of every reference."""
    return ev.flatten_params(views.references(spark, sf_dir), ["row_id"], "ref_text")


@register(
    "match_params",
    with_views(
        "SELECT p.row_id, p.path FROM pred_flat p JOIN ref_flat r "
        "ON p.row_id = r.row_id AND p.path = r.path AND p.vkey IS NOT DISTINCT FROM r.vkey",
        "pred_flat", "ref_flat",
    ),
)
def q_match_params(spark, sf_dir):
    """Predicted leaves that equal the reference leaf at the same path."""
    return ev.matched_leaves(_aligned(spark, sf_dir)).where("equal").select("row_id", "path")


PRF = """
SELECT correct, predicted, reference,
       round(p, 6) AS param_precision, round(r, 6) AS param_recall,
       round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END, 6) AS param_f1
FROM (SELECT *, CASE WHEN predicted > 0 THEN CAST(correct AS DOUBLE) * 100.0 / predicted ELSE 0.0 END AS p,
                CASE WHEN reference > 0 THEN CAST(correct AS DOUBLE) * 100.0 / reference ELSE 0.0 END AS r
      FROM (SELECT (SELECT count(*) FROM pred_flat p JOIN ref_flat r ON p.row_id = r.row_id AND p.path = r.path
                     AND p.vkey IS NOT DISTINCT FROM r.vkey) AS correct,
                   (SELECT count(*) FROM pred_flat) AS predicted,
                   (SELECT count(*) FROM ref_flat) AS reference) c) x
"""


@register("param_prf", with_views(PRF, "pred_flat", "ref_flat"))
def q_param_prf(spark, sf_dir):
    """Micro precision / recall / F1 over flattened params."""
    return rounded(ev.param_prf(ev.param_counts(_aligned(spark, sf_dir))))


@register(
    "evaluation_report",
    with_views(
        f"""SELECT s.*, m.param_precision, m.param_recall, m.param_f1
FROM (SELECT {_pct_sql('coalesce(pred_text = ref_text, false)', 'exact_match')},
             {_pct_sql('intent_pred IS NOT DISTINCT FROM intent_true', 'intent_accuracy')},
             {_pct_sql("intent_pred IS DISTINCT FROM 'PARSE_ERROR'", 'parse_success_rate')},
             count(*) AS total_samples FROM aligned) s, ({PRF}) m""",
        "aligned", "pred_flat", "ref_flat",
    ),
)
def q_evaluation_report(spark, sf_dir):
    """All scalar metrics in one row."""
    return rounded(ev.evaluation_report(_aligned(spark, sf_dir)))
