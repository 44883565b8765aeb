"""Evaluation of model outputs against references.

Rows are matched by ``row_id`` (an equi-join), never by position.  Metric
semantics follow the original evaluator:

* P7 predicted intent: strict JSON object -> its ``intent`` (``UNKNOWN`` when
  the key is missing); anything else -> ``PARSE_ERROR``.
* P8 reference intent: same, but every failure -> ``UNKNOWN``.
* A21 parameters: both sides flattened to dotted paths and compared as Python
  compares them (``parlance.functions.leaves``); a pair counts only when both
  sides are JSON objects whose ``params`` is an object or missing. The two
  texts of a pair are read together, so there is no grouping and a repeated
  ``row_id`` counts each time; nothing runs while a plan is built.
* Percentages are 0-100; empty input gives null.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlance.functions import leaves
from parlance.functions.json import strict_json

# Travels with its tasks, so executors need only pyarrow for it.
cloudpickle.register_pickle_by_value(leaves)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_object_text(text) -> Column:
    """True for a strict JSON text whose top level is an object."""
    t = _c(text)
    return strict_json(t) & F.ltrim(t).startswith("{")


def _intent_of(text) -> tuple[Column, Column]:
    t = _c(text)
    has_key = F.coalesce(F.array_contains(F.json_object_keys(t), F.lit("intent")), F.lit(False))
    value = F.from_json(t, "struct<intent:string>")["intent"]
    return has_key, value


def extract_pred_intent(text) -> Column:
    """Intent of a model output; ``UNKNOWN`` / ``PARSE_ERROR`` on failure."""
    has_key, value = _intent_of(text)
    return (
        F.when(~json_object_text(text), F.lit("PARSE_ERROR"))
        .when(has_key, value)
        .otherwise(F.lit("UNKNOWN"))
    )


def extract_ref_intent(text) -> Column:
    """Intent of a reference; every failure is ``UNKNOWN``."""
    has_key, value = _intent_of(text)
    return F.when(json_object_text(text) & has_key, value).otherwise(F.lit("UNKNOWN"))


def align_predictions(pred: DataFrame, ref: DataFrame) -> DataFrame:
    """Prediction with its reference, equi-join on ``row_id``.

    Adds ``intent_pred`` (P7) and ``intent_true`` (P8).
    """
    return (
        pred.join(ref, "row_id", "inner")
        .withColumn("intent_pred", extract_pred_intent("pred_text"))
        .withColumn("intent_true", extract_ref_intent("ref_text"))
    )


def _pct(cond: Column) -> Column:
    return F.avg(F.when(cond, 1.0).otherwise(0.0)) * 100.0


def exact_match() -> Column:
    """Percent of identical output texts."""
    return _pct(F.coalesce(F.col("pred_text") == F.col("ref_text"), F.lit(False))).alias("exact_match")


def intent_accuracy() -> Column:
    """Percent of equal intents (null equals null)."""
    return _pct(F.col("intent_pred").eqNullSafe(F.col("intent_true"))).alias("intent_accuracy")


def parse_success_rate() -> Column:
    """Percent of predictions whose intent is not ``PARSE_ERROR``."""
    return _pct(~F.col("intent_pred").eqNullSafe(F.lit("PARSE_ERROR"))).alias("parse_success_rate")


def _count(cond: Column, name: str) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint").alias(name)


def evaluation_tally(aligned: DataFrame, *by: str) -> DataFrame:
    """Per ``by`` and true intent the counts behind A22 and A23, from one pass over the pairs.

    They add up, so both metrics of every evaluation set come from this small table.
    """
    return _with_counts(aligned).groupBy(*by, "intent_true").agg(
        _count(F.col("intent_pred").eqNullSafe(F.col("intent_true")), "correct"),
        F.count(F.lit(1)).alias("total"),
        _count(F.coalesce(F.col("pred_text") == F.col("ref_text"), F.lit(False)), "exact"),
        _count(~F.col("intent_pred").eqNullSafe(F.lit("PARSE_ERROR")), "parsed"),
        *(F.sum(f"_leaves.{c}").alias(f"leaves_{c}") for c in PAIR_COUNTS),
    )


def tallied_accuracy(tally: DataFrame) -> DataFrame:
    """A22 from the tally of one set: by true intent: correct, total, accuracy (percent)."""
    return tally.select("intent_true", "correct", "total", (F.col("correct") / F.col("total") * 100.0).alias("accuracy"))


def per_intent_accuracy(aligned: DataFrame) -> DataFrame:
    """By true intent: correct, total, accuracy (percent)."""
    return tallied_accuracy(evaluation_tally(aligned))


def top_intent_accuracy(per_intent: DataFrame, k: int = 10) -> DataFrame:
    """K5: the ``k`` intents with most rows (ties by intent name)."""
    return per_intent.orderBy(F.col("total").desc(), F.col("intent_true")).limit(k)


def bottom_intent_accuracy(per_intent: DataFrame, k: int = 5) -> DataFrame:
    """K6: the ``k`` intents with the lowest accuracy, by its full value (ties by intent name)."""
    return per_intent.orderBy(F.col("correct") / F.col("total"), F.col("intent_true")).limit(k)


# --- parameters -----------------------------------------------------------------


def flatten_params(df: DataFrame, id_cols: list[str], text: str) -> DataFrame:
    """``id_cols, path, kind, vkey``, one row per leaf of the params of the result ``text``.

    Equal ``vkey`` is equality of values; a text without params has no row.
    """
    rows = df.select(*id_cols, text)
    made = [T.StructField(n, T.StringType()) for n in ("path", "kind", "vkey")]
    return rows.mapInArrow(leaves.flat_batches, T.StructType([*rows.schema.fields[:-1], *made]))


def matched_leaves(aligned: DataFrame) -> DataFrame:
    """``row_id, path, pkey, rkey, equal`` for every path of either side of a pair: no grouping, no join."""
    rows = aligned.select("row_id", "pred_text", "ref_text")
    made = [*(T.StructField(n, T.StringType()) for n in ("path", "pkey", "rkey")), T.StructField("equal", T.BooleanType())]
    return rows.mapInArrow(leaves.matched_batches, T.StructType([rows.schema.fields[0], *made]))


PAIR_COUNTS = ("correct", "predicted", "reference")


def _with_counts(aligned: DataFrame) -> DataFrame:
    """``aligned`` with ``_leaves``: how many leaves of each pair are equal, predicted and in the reference."""
    count = F.arrow_udf(leaves.count_pairs, "correct long, predicted long, reference long")
    return aligned.withColumn("_leaves", count("pred_text", "ref_text"))


def _total_counts() -> list[Column]:
    return [F.coalesce(F.sum(f"_leaves.{c}"), F.lit(0)).alias(c) for c in PAIR_COUNTS]


def param_counts(aligned: DataFrame) -> DataFrame:
    """J3 + A21 inputs: total correct, predicted and reference leaves."""
    return _with_counts(aligned).agg(*_total_counts())


def param_prf(counts: DataFrame) -> DataFrame:
    """Micro precision, recall and F1 in percent (0 when undefined)."""
    p = F.when(F.col("predicted") > 0, F.col("correct") * 100.0 / F.col("predicted")).otherwise(0.0)
    r = F.when(F.col("reference") > 0, F.col("correct") * 100.0 / F.col("reference")).otherwise(0.0)
    f1 = F.when(F.col("param_precision") + F.col("param_recall") > 0, 2 * F.col("param_precision") * F.col("param_recall") / (F.col("param_precision") + F.col("param_recall")))
    return counts.withColumns({"param_precision": p, "param_recall": r}).withColumn("param_f1", f1.otherwise(0.0))


def tallied_report(tally: DataFrame) -> DataFrame:
    """A23 from the tally of one set: every scalar metric and the sample count in one row."""
    shares = {"exact_match": "exact", "intent_accuracy": "correct", "parse_success_rate": "parsed"}
    scalars = [(F.sum(c) / F.sum("total") * 100.0).alias(name) for name, c in shares.items()]
    counts = [F.coalesce(F.sum(f"leaves_{c}"), F.lit(0)).alias(c) for c in PAIR_COUNTS]
    total = F.coalesce(F.sum("total"), F.lit(0)).alias("total_samples")
    return param_prf(tally.agg(*scalars, total, *counts)).drop(*PAIR_COUNTS)


def evaluation_report(aligned: DataFrame) -> DataFrame:
    """Every scalar metric and the sample count in one row, from one pass over the pairs."""
    return tallied_report(evaluation_tally(aligned))
