"""Parameter-schema mining.

The annotation column is parsed once into a long table of top-level
parameter entries ``(row_id, ann_intent, param, kind, type_name, v)``;
every statistic is an aggregation of that table (partial + final), so a hot
intent never lands in one task.

Semantics kept from the original analysis script:

* only rows whose annotation is a non-empty JSON list with an object first
  element count; their intent is the element's ``id`` when present, else the
  intent column (P6);
* only a ``params`` *object* yields entries;
* numbers *and booleans* form the numeric range (a boolean is an int there),
  and the range is shown only for parameters without string values;
* the number of intents without params is the number of distinct intent
  column values (null included) minus the intents with params, which may be
  negative.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parlance.functions.json import py_type_name, variant_kind
from parlance.operators.annotations import annotate, params_flag


def annotated_rows(utt: DataFrame) -> DataFrame:
    """Rows usable for mining, with ``ann_intent`` and the params VARIANT."""
    a = annotate(utt, keep_variant=True)
    return a.where(F.col("a_elem_object")).select(
        "row_id",
        "transcript",
        F.when(F.col("a_has_id"), F.col("a_ann_id")).otherwise(F.col("intent")).alias("ann_intent"),
        "a_params",
        "a_params_kind",
        "a_params_v",
    )


def param_entries(rows: DataFrame) -> DataFrame:
    """Long table of top-level params: ``row_id, ann_intent, param, kind, type_name, v``."""
    ex = rows.where(F.col("a_params_kind") == "OBJECT").select(
        "row_id",
        "ann_intent",
        F.explode(F.try_variant_get("a_params_v", "$", "map<string,variant>")).alias("param", "v"),
    )
    ex = ex.withColumn("kind", variant_kind("v"))
    return ex.withColumn("type_name", py_type_name(F.col("kind")))


def value_type_name(entries: DataFrame) -> DataFrame:
    """Python type name of each parameter value."""
    return entries.select("row_id", "param", "type_name")


def param_schema(entries: DataFrame) -> DataFrame:
    """A8 / U2 per intent: the set of value types of every parameter."""
    return entries.groupBy("ann_intent", "param").agg(
        F.array_join(F.sort_array(F.collect_set("type_name")), ",").alias("types")
    )


def type_set_union(entries: DataFrame) -> DataFrame:
    """The union of value types of each parameter key over all intents."""
    return entries.groupBy("param").agg(F.array_join(F.sort_array(F.collect_set("type_name")), ",").alias("types"))


def param_type_counts(entries: DataFrame) -> DataFrame:
    """Occurrences per (intent, param, type) and per (intent, param) in total."""
    per = entries.groupBy("ann_intent", "param", "type_name").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("ann_intent", "param")
    return per.withColumn("total", F.sum("n").over(w).cast("bigint"))


def param_string_values(entries: DataFrame) -> DataFrame:
    """A10: distinct string values per (intent, param) with their counts."""
    s = entries.where(F.col("kind") == "STRING").select(
        "row_id", "ann_intent", "param", F.try_variant_get("v", "$", "string").alias("value")
    )
    return s.groupBy("ann_intent", "param", "value").agg(
        F.count(F.lit(1)).alias("n"), F.min("row_id").alias("first_row")
    )


def _numeric_value(entries: DataFrame) -> DataFrame:
    """``num``: a number as (double, all digits of a whole number), null for other kinds.

    Ordered by its fields, as two whole numbers may share a double.  Whole
    numbers of more than 38 digits arrive as doubles from the JSON reader.
    """
    num = (
        F.when(F.col("kind").isin("INT", "FLOAT"), F.try_variant_get("v", "$", "double"))
        .when(F.col("kind") == "BOOLEAN", F.try_variant_get("v", "$", "boolean").cast("int").cast("double"))
    )
    digits = F.when(F.col("kind") == "INT", F.try_variant_get("v", "$", "decimal(38,0)")).when(
        (F.abs(num) < 1e38) & (num == F.rint(num)), num.cast("decimal(38,0)")
    )
    both = F.struct(num.alias("value"), digits.alias("digits"))
    return entries.select("ann_intent", "param", "kind", F.when(num.isNotNull(), both).alias("num"))


def param_numeric_range(entries: DataFrame) -> DataFrame:
    """Min, max, and distinct count (at most 10) of numeric values.

    Only for parameters that have numeric values and no string values.
    ``min_whole`` and ``max_whole`` hold all digits (DECIMAL) of a minimum and
    maximum that are whole numbers, null for others.
    """
    x = _numeric_value(entries)
    agg = x.groupBy("ann_intent", "param").agg(
        F.min("num").alias("_min"),
        F.max("num").alias("_max"),
        F.count_distinct("num").alias("_distinct"),
        F.max(F.when(F.col("kind") == "STRING", 1).otherwise(0)).alias("_has_str"),
    )
    return agg.where(F.col("_min").isNotNull() & (F.col("_has_str") == 0)).select(
        "ann_intent",
        "param",
        F.col("_min.value").alias("min_value"),
        F.col("_max.value").alias("max_value"),
        F.col("_min.digits").alias("min_whole"),
        F.col("_max.digits").alias("max_whole"),
        F.least(F.col("_distinct"), F.lit(10)).cast("bigint").alias("shown_values"),
    )


def intents_with_params(entries: DataFrame) -> DataFrame:
    """Annotation intents with at least one parameter key."""
    return entries.select("ann_intent").distinct()


def intent_param_coverage(utt: DataFrame, entries: DataFrame) -> DataFrame:
    """Intents with params, without (total minus with), and the total."""
    with_p = intents_with_params(entries).agg(F.count(F.lit(1)).alias("intents_with_params"))
    total = utt.agg(
        (F.count_distinct("intent") + F.max(F.when(F.col("intent").isNull(), 1).otherwise(0))).cast("bigint")
        .alias("total_intents")
    )
    return with_p.crossJoin(total).select(
        "intents_with_params",
        (F.col("total_intents") - F.col("intents_with_params")).alias("intents_without_params"),
        "total_intents",
    )


def utterance_param_coverage(utt: DataFrame) -> DataFrame:
    """Rows with / without params and their percent of all rows."""
    a = annotate(utt).select(params_flag().alias("flag"))
    agg = a.agg(
        F.sum(F.when(F.col("flag") == "with", 1).otherwise(0)).cast("bigint").alias("rows_with_params"),
        F.sum(F.when(F.col("flag") == "without", 1).otherwise(0)).cast("bigint").alias("rows_without_params"),
        F.count(F.lit(1)).alias("total_rows"),
    )
    return agg.select(
        "rows_with_params",
        "rows_without_params",
        "total_rows",
        F.try_divide(F.col("rows_with_params") * F.lit(100.0), "total_rows").alias("pct_with"),
        F.try_divide(F.col("rows_without_params") * F.lit(100.0), "total_rows").alias("pct_without"),
    )


def param_key_spread(entries: DataFrame) -> DataFrame:
    """Number of intents that use each parameter key."""
    return entries.select("param", "ann_intent").distinct().groupBy("param").agg(
        F.count(F.lit(1)).alias("n_intents")
    )


def top_param_keys(spread: DataFrame, k: int = 15) -> DataFrame:
    """K4: the ``k`` keys used by most intents (ties by key)."""
    return spread.orderBy(F.col("n_intents").desc(), F.col("param")).limit(k)


def rank_intents_by_volume(utt: DataFrame, entries: DataFrame) -> DataFrame:
    """Intents (by the intent column) that have mined params, with row counts."""
    counts = utt.where(F.col("intent").isNotNull()).groupBy("intent").agg(F.count(F.lit(1)).alias("n_rows"))
    params = entries.groupBy("ann_intent").agg(F.count_distinct("param").alias("n_params"))
    return counts.join(params, counts["intent"] == params["ann_intent"], "inner").select(
        "intent", "n_rows", "n_params"
    )


def top_intents_with_params(ranked: DataFrame, k: int = 20) -> DataFrame:
    """K3: the ``k`` largest intents that have params (ties by name)."""
    return ranked.orderBy(F.col("n_rows").desc(), F.col("intent")).limit(k)


def sample_per_intent(rows: DataFrame, k: int = 3) -> DataFrame:
    """First ``k`` usable rows per annotation intent, by ``row_id``.

    ``row_number() <= k`` is planned with a window group limit, so each
    partition ships at most ``k`` rows per intent to the shuffle.
    """
    w = Window.partitionBy("ann_intent").orderBy("row_id")
    return (
        rows.withColumn("rn", F.row_number().over(w))
        .where(F.col("rn") <= k)
        .select("ann_intent", "row_id", "transcript", F.col("a_params").alias("params"), F.col("rn").cast("bigint").alias("rn"))
    )


def param_examples(string_values: DataFrame, k: int = 10) -> DataFrame:
    """K7: first ``k`` distinct string values per (intent, param), first-seen order."""
    w = Window.partitionBy("ann_intent", "param").orderBy("first_row", "value")
    return (
        string_values.withColumn("rn", F.row_number().over(w))
        .where(F.col("rn") <= k)
        .select("ann_intent", "param", "value", "first_row", F.col("rn").cast("bigint").alias("rn"))
    )


def distinct_intents(utt: DataFrame) -> DataFrame:
    """The distinct values of the intent column."""
    return utt.select("intent").distinct()

