"""Registered queries: parameter-schema mining."""

from __future__ import annotations

from pyspark.sql import functions as F

from parlance.operators import schema_mining as sm
from parlance.plans.oracle_sql import with_views
from parlance.plans.registry import register, rounded
from parlance.sources import views


def _entries(spark, sf_dir):
    return sm.param_entries(sm.annotated_rows(views.utterances(spark, sf_dir)))


_TYPES = "array_to_string(list_sort(list_distinct(list(type_name))), ',') AS types"
STRING_VALUES = (
    "SELECT ann_intent, param, sval AS value, count(*) AS n, min(row_id) AS first_row "
    "FROM entries WHERE kind = 'STRING' GROUP BY ann_intent, param, sval"
)


@register("value_type_name", with_views("SELECT row_id, param, type_name FROM entries", "entries"))
def q_value_type_name(spark, sf_dir):
    """Python type name of every top-level parameter value."""
    return sm.value_type_name(_entries(spark, sf_dir))


@register("param_schema", with_views(f"SELECT ann_intent, param, {_TYPES} FROM entries GROUP BY ann_intent, param", "entries"))
def q_param_schema(spark, sf_dir):
    """Type set per (intent, param)."""
    return sm.param_schema(_entries(spark, sf_dir))


@register("type_set_union", with_views(f"SELECT param, {_TYPES} FROM entries GROUP BY param", "entries"))
def q_type_set_union(spark, sf_dir):
    """Union of types per parameter key."""
    return sm.type_set_union(_entries(spark, sf_dir))


@register(
    "param_type_counts",
    with_views(
        "SELECT ann_intent, param, type_name, count(*) AS n, "
        "CAST(sum(count(*)) OVER (PARTITION BY ann_intent, param) AS BIGINT) AS total "
        "FROM entries GROUP BY ann_intent, param, type_name",
        "entries",
    ),
)
def q_param_type_counts(spark, sf_dir):
    """Occurrences per (intent, param, type) and per (intent, param)."""
    return sm.param_type_counts(_entries(spark, sf_dir))


@register("param_string_values", with_views(STRING_VALUES, "entries"))
def q_param_string_values(spark, sf_dir):
    """A10: string values with counts."""
    return sm.param_string_values(_entries(spark, sf_dir))


@register(
    "param_numeric_range",
    with_views(
        "SELECT ann_intent, param, min(num) AS min_value, max(num) AS max_value, "
        "CAST(CASE WHEN min(num) = round(min(num)) THEN CAST(min(num) AS HUGEINT) END AS VARCHAR) AS min_whole, "
        "CAST(CASE WHEN max(num) = round(max(num)) THEN CAST(max(num) AS HUGEINT) END AS VARCHAR) AS max_whole, "
        "CAST(least(count(DISTINCT num), 10) AS BIGINT) AS shown_values FROM entries "
        "GROUP BY ann_intent, param HAVING min(num) IS NOT NULL AND max(CASE WHEN kind = 'STRING' THEN 1 ELSE 0 END) = 0",
        "entries",
    ),
)
def q_param_numeric_range(spark, sf_dir):
    """Numeric range of parameters without string values."""
    found = sm.param_numeric_range(_entries(spark, sf_dir))
    return found.withColumns({c: F.col(c).cast("string") for c in ("min_whole", "max_whole")})


@register(
    "intent_param_coverage",
    with_views(
        "SELECT w.n AS intents_with_params, t.n - w.n AS intents_without_params, t.n AS total_intents "
        "FROM (SELECT count(DISTINCT ann_intent) + max(CASE WHEN ann_intent IS NULL THEN 1 ELSE 0 END) AS n FROM entries) w, "
        "(SELECT CAST(count(DISTINCT intent) + max(CASE WHEN intent IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n FROM utterances) t",
        "entries", "utterances",
    ),
)
def q_intent_param_coverage(spark, sf_dir):
    """Intents with and without params."""
    utt = views.utterances(spark, sf_dir)
    return sm.intent_param_coverage(utt, sm.param_entries(sm.annotated_rows(utt)))


@register(
    "utterance_param_coverage",
    with_views(
        """SELECT rows_with_params, rows_without_params, total_rows,
       round(CAST(rows_with_params AS DOUBLE) * 100.0 / total_rows, 6) AS pct_with,
       round(CAST(rows_without_params AS DOUBLE) * 100.0 / total_rows, 6) AS pct_without
FROM (SELECT CAST(sum(CASE WHEN flag = 'with' THEN 1 ELSE 0 END) AS BIGINT) AS rows_with_params,
             CAST(sum(CASE WHEN flag = 'without' THEN 1 ELSE 0 END) AS BIGINT) AS rows_without_params,
             count(*) AS total_rows
      FROM (""" + __import__("parlance.plans.q_preprocess", fromlist=["F4_SQL"]).F4_SQL.replace("params_flag", "flag") + """) f) c""",
    ),
)
def q_utterance_param_coverage(spark, sf_dir):
    """Rows with and without params."""
    return rounded(sm.utterance_param_coverage(views.utterances(spark, sf_dir)))


SPREAD = "SELECT param, count(DISTINCT ann_intent) AS n_intents FROM entries GROUP BY param"


@register("param_key_spread", with_views(SPREAD, "entries"))
def q_param_key_spread(spark, sf_dir):
    """Intents per parameter key."""
    return sm.param_key_spread(_entries(spark, sf_dir))


@register("top_param_keys", with_views(f"SELECT * FROM ({SPREAD}) s ORDER BY n_intents DESC, param LIMIT 15", "entries"))
def q_top_param_keys(spark, sf_dir):
    """K4: fifteen most widely used keys."""
    return sm.top_param_keys(sm.param_key_spread(_entries(spark, sf_dir)))


RANKED = (
    "SELECT c.intent, c.n_rows, p.n_params FROM "
    "(SELECT intent, count(*) AS n_rows FROM utterances WHERE intent IS NOT NULL GROUP BY intent) c "
    "JOIN (SELECT ann_intent, count(DISTINCT param) AS n_params FROM entries GROUP BY ann_intent) p "
    "ON c.intent = p.ann_intent"
)


@register("rank_intents_by_volume", with_views(RANKED, "entries", "utterances"))
def q_rank_intents_by_volume(spark, sf_dir):
    """Intents with params and their row counts."""
    utt = views.utterances(spark, sf_dir)
    return sm.rank_intents_by_volume(utt, sm.param_entries(sm.annotated_rows(utt)))


@register(
    "top_intents_with_params",
    with_views(f"SELECT * FROM ({RANKED}) r ORDER BY n_rows DESC, intent LIMIT 20", "entries", "utterances"),
)
def q_top_intents_with_params(spark, sf_dir):
    """K3: twenty largest intents that have params."""
    utt = views.utterances(spark, sf_dir)
    return sm.top_intents_with_params(sm.rank_intents_by_volume(utt, sm.param_entries(sm.annotated_rows(utt))))


@register(
    "sample_per_intent",
    with_views(
        "SELECT ann_intent, row_id, transcript, params, rn FROM "
        "(SELECT *, row_number() OVER (PARTITION BY ann_intent ORDER BY row_id) AS rn FROM mined) m WHERE rn <= 3",
        "mined",
    ),
)
def q_sample_per_intent(spark, sf_dir):
    """First three usable rows per intent."""
    return sm.sample_per_intent(sm.annotated_rows(views.utterances(spark, sf_dir)))


@register(
    "param_examples",
    with_views(
        f"SELECT ann_intent, param, value, first_row, rn FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY ann_intent, param ORDER BY first_row, value) AS rn FROM ({STRING_VALUES}) s) x WHERE rn <= 10",
        "entries",
    ),
)
def q_param_examples(spark, sf_dir):
    """K7: first ten distinct string values per (intent, param)."""
    return sm.param_examples(sm.param_string_values(_entries(spark, sf_dir)))


@register("distinct_intents", with_views("SELECT DISTINCT intent FROM utterances", "utterances"))
def q_distinct_intents(spark, sf_dir):
    """Distinct intents."""
    return sm.distinct_intents(views.utterances(spark, sf_dir))
