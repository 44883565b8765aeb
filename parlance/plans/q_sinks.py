"""Registered queries: result sinks checked by read-back."""

from __future__ import annotations

from pyspark.sql import functions as F

from parlance.config import scratch_path
from parlance.operators import evaluate as ev
from parlance.operators import splits as sp
from parlance.plans.oracle_sql import with_views
from parlance.plans.q_evaluate import PER_INTENT, PRF, _pct_sql
from parlance.plans.q_splits import stored_membership, stored_splits
from parlance.plans.registry import register, rounded
from parlance.sources import tables, views


@register(
    "sink_sample",
    with_views("SELECT row_id, transcript, intent, nli_output, frequency FROM utterances ORDER BY row_id LIMIT 20", "utterances"),
)
def q_sink_sample(spark, sf_dir):
    """First 20 raw rows written to one CSV file and read back."""
    path = scratch_path(spark, "sample")
    tables.sink_sample(views.utterances(spark, sf_dir), path, 20)
    return tables.scan_utterances(spark, path, fmt="csv")


@register(
    "sink_intent_stats",
    with_views(
        "SELECT (SELECT count(DISTINCT intent) FROM splits WHERE split = 'train') AS total_intents, "
        "(SELECT string_agg(intent, ',' ORDER BY intent) FROM (SELECT DISTINCT intent FROM splits WHERE split = 'train') d) AS intent_list, "
        "string_agg(split || '/' || intent || '=' || n, ',' ORDER BY split || '/' || intent || '=' || n) AS counts "
        "FROM (SELECT split, intent, CAST(count(*) AS VARCHAR) AS n FROM splits GROUP BY split, intent) c",
        "splits",
    ),
)
def q_sink_intent_stats(spark, sf_dir):
    """One statistics document (counts per split and intent, total and list once) as JSON."""
    s = stored_splits(spark, sf_dir)
    # One row per split and intent; the document lists each once.
    counts = sp.intent_stats(s).agg(F.sort_array(F.collect_list(F.struct("split", "intent", "n"))).alias("counts"))
    path = scratch_path(spark, "intent_stats")
    tables.sink_json(sp.intent_inventory(s).join(counts), path)
    doc = spark.read.schema(
        "total_intents bigint, intent_list string, counts array<struct<split:string,intent:string,n:bigint>>"
    ).json(path)
    text = F.transform("counts", lambda c: F.concat(c["split"], F.lit("/"), c["intent"], F.lit("="), c["n"].cast("string")))
    return doc.select("total_intents", "intent_list", F.array_join(F.array_sort(text), ",").alias("counts"))


def _metrics_sql(eval_set: str) -> str:
    """The metrics document of one split."""
    own = f"(SELECT row_id FROM splits WHERE split = '{eval_set}')"
    prf = PRF.replace("FROM pred_flat p JOIN ref_flat r ON", f"FROM (SELECT * FROM pred_flat WHERE row_id IN {own}) p JOIN ref_flat r ON")
    prf = prf.replace("count(*) FROM pred_flat)", f"count(*) FROM pred_flat WHERE row_id IN {own})")
    prf = prf.replace("count(*) FROM ref_flat)", f"count(*) FROM ref_flat WHERE row_id IN {own})")
    rows = f"(SELECT * FROM aligned WHERE row_id IN {own})"
    per = PER_INTENT.replace("FROM aligned", f"FROM {rows} a")
    return f"""SELECT '{eval_set}' AS eval_set, s.*, m.param_precision, m.param_recall, m.param_f1, i.per_intent
FROM (SELECT {_pct_sql('coalesce(pred_text = ref_text, false)', 'exact_match')},
             {_pct_sql('intent_pred IS NOT DISTINCT FROM intent_true', 'intent_accuracy')},
             {_pct_sql("intent_pred IS DISTINCT FROM 'PARSE_ERROR'", 'parse_success_rate')},
             count(*) AS total_samples FROM {rows} a) s, ({prf}) m,
     (SELECT string_agg(concat(intent_true, '=', correct, '/', total), ',' ORDER BY intent_true) AS per_intent FROM ({per}) p) i"""


@register(
    "sink_metrics",
    with_views(f"{_metrics_sql('val')}\nUNION ALL\n{_metrics_sql('test')}", "aligned", "pred_flat", "ref_flat", "splits"),
)
def q_sink_metrics(spark, sf_dir):
    """A metrics document per evaluation set (val, test), with the accuracy per intent, written as JSON and read back."""
    sets = ("val", "test")
    # Joined before the texts are read, so that only the rows of the sets are.
    own = stored_membership(spark, sf_dir).where(F.col("split").isin(*sets)).select("row_id", "split")
    ref = views.references(spark, sf_dir).select("row_id", "ref_text").join(own, "row_id")
    aligned = ev.align_predictions(views.predictions(spark, sf_dir), ref)
    path = scratch_path(spark, "metrics")
    ev.evaluation_tally(aligned, "split").write.parquet(f"{path}/tally")
    tally = spark.read.parquet(f"{path}/tally")
    for eval_set in sets:
        rows = tally.where(F.col("split") == eval_set)
        per = F.sort_array(F.collect_list(F.struct("intent_true", "correct", "total", "accuracy")))
        per_intent = ev.tallied_accuracy(rows).agg(per.alias("per_intent_accuracy"))  # one entry per intent
        report = ev.tallied_report(rows).join(per_intent).withColumn("eval_set", F.lit(eval_set))
        tables.sink_json(report, f"{path}/{eval_set}")
    docs = spark.read.schema(
        "eval_set string, exact_match double, intent_accuracy double, parse_success_rate double, "
        "total_samples bigint, param_precision double, param_recall double, param_f1 double, "
        "per_intent_accuracy array<struct<intent_true:string,correct:bigint,total:bigint,accuracy:double>>"
    ).json([f"{path}/val", f"{path}/test"])
    text = F.transform(
        "per_intent_accuracy",
        lambda p: F.concat(p["intent_true"], F.lit("="), p["correct"].cast("string"), F.lit("/"), p["total"].cast("string")),
    )
    return rounded(docs.withColumn("per_intent", F.array_join(text, ",")).drop("per_intent_accuracy"))
