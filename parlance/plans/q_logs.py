"""Registered queries: training-log and latency analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from parlance.config import scratch_path
from parlance.operators import latency as lat
from parlance.operators import outputs as out
from parlance.operators import training_log as tl
from parlance.plans.oracle_sql import with_views
from parlance.plans.q_outputs import CLASSIFIED, SINGLE, _classified, _single
from parlance.plans.registry import register, rounded
from parlance.sources import views

BATCH_LOSS = (
    "SELECT event_id % 15 + 1 AS epoch, CASE WHEN user_id % 2 = 0 THEN 'train' ELSE 'val' END AS split, "
    "event_id AS step, value / 100 AS loss FROM events"
)
EPOCH_MEANS = (
    "SELECT epoch, split, avg(loss) AS mean_loss, count(*) AS n_batches FROM batch_loss GROUP BY epoch, split"
)
HISTORY = (
    "SELECT epoch, max(CASE WHEN split = 'train' THEN mean_loss END) AS train_loss, "
    "max(CASE WHEN split = 'val' THEN mean_loss END) AS val_loss FROM epoch_means GROUP BY epoch"
)
LOG_VIEWS = {"batch_loss": BATCH_LOSS, "epoch_means": EPOCH_MEANS, "history": HISTORY}


def _hist(spark, sf_dir):
    return tl.history(tl.epoch_mean_loss(views.batch_loss(spark, sf_dir)))


@register("epoch_mean_loss", with_views("SELECT epoch, split, round(mean_loss, 6) AS mean_loss, n_batches FROM epoch_means", extra=LOG_VIEWS))
def q_epoch_mean_loss(spark, sf_dir):
    """Mean batch loss per epoch and split."""
    return rounded(tl.epoch_mean_loss(views.batch_loss(spark, sf_dir)), "mean_loss")


@register(
    "running_best_loss",
    with_views(
        """SELECT epoch, round(val_loss, 6) AS val_loss, round(best_before, 6) AS best_before,
       best_before IS NULL OR val_loss < best_before AS is_best,
       round(least(coalesce(best_before, val_loss), val_loss), 6) AS best_so_far, epoch % 1 = 0 AS save_checkpoint
FROM (SELECT epoch, val_loss, min(val_loss) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before
      FROM history) h""",
        extra=LOG_VIEWS,
    ),
)
def q_running_best_loss(spark, sf_dir):
    """Best validation loss so far and the checkpoint flags."""
    return rounded(tl.running_best_loss(_hist(spark, sf_dir)), "val_loss", "best_before", "best_so_far")


@register(
    "loss_delta",
    with_views(
        """SELECT n_epochs, CASE WHEN n_epochs > 2 THEN round(delta, 6) END AS last_delta,
       CASE WHEN n_epochs <= 2 THEN NULL WHEN abs(delta) < 0.01 THEN 'plateau'
            WHEN delta > 0 THEN 'increased' ELSE 'decreasing' END AS status
FROM (SELECT epoch, train_loss - lag(train_loss) OVER (ORDER BY epoch) AS delta, count(*) OVER () AS n_epochs,
             row_number() OVER (ORDER BY epoch DESC) AS r FROM history) h WHERE r = 1""",
        extra=LOG_VIEWS,
    ),
)
def q_loss_delta(spark, sf_dir):
    """Change of the train loss in the last epoch."""
    return rounded(tl.loss_delta(_hist(spark, sf_dir)), "last_delta")


@register(
    "generalization_gap",
    with_views(
        "SELECT epoch, round(val_loss - train_loss, 6) AS gap, CASE WHEN val_loss - train_loss > 0.5 THEN 'overfitting' "
        "WHEN val_loss - train_loss < 0.3 THEN 'good' ELSE 'ok' END AS status FROM history",
        extra=LOG_VIEWS,
    ),
)
def q_generalization_gap(spark, sf_dir):
    """Validation minus train loss per epoch."""
    return rounded(tl.generalization_gap(_hist(spark, sf_dir)), "gap")


@register(
    "final_gap",
    with_views(
        "SELECT max(epoch) AS epoch, round(arg_max(val_loss - train_loss, epoch), 6) AS final_gap FROM history",
        extra=LOG_VIEWS,
    ),
)
def q_final_gap(spark, sf_dir):
    """Gap of the last epoch."""
    return rounded(tl.final_gap(_hist(spark, sf_dir)), "final_gap")


@register(
    "diagnosis_flags",
    with_views(
        f"""SELECT round(final_val_loss, 6) AS final_val_loss,
       CASE WHEN final_val_loss > 1.0 THEN 'high' WHEN final_val_loss > 0.5 THEN 'moderate' ELSE 'low' END AS loss_band,
       parse_error_pct, parse_error_pct > 30.0 AS high_parse_error,
       missing_params_pct, missing_params_pct > 20.0 AS missing_params_issue
FROM (SELECT arg_max(val_loss, epoch) AS final_val_loss FROM history) h,
     (SELECT round(CAST(count(*) FILTER (WHERE issue = 'json_parse_error') AS DOUBLE) * 100.0 / count(*), 6) AS parse_error_pct,
             round(CAST(count(*) FILTER (WHERE issue = 'missing_params') AS DOUBLE) * 100.0 / count(*), 6) AS missing_params_pct
      FROM ({CLASSIFIED}) c) i""",
        "predictions", "utterances",
        extra=LOG_VIEWS,
    ),
)
def q_diagnosis_flags(spark, sf_dir):
    """Loss band and issue-rate flags."""
    flags = tl.diagnosis_flags(_hist(spark, sf_dir), out.issue_summary(_classified(spark, sf_dir)))
    return rounded(flags, "final_val_loss", "parse_error_pct", "missing_params_pct")


@register("history_roundtrip", with_views(
        "SELECT epoch, round(train_loss, 6) AS train_loss, round(val_loss, 6) AS val_loss, CAST(epoch AS DOUBLE) / 1000 AS learning_rate FROM history",
        extra=LOG_VIEWS,
    ),
)
def q_history_roundtrip(spark, sf_dir):
    """History written as one JSON document of arrays, read back as rows."""
    path = scratch_path(spark, "history")
    hist = _hist(spark, sf_dir).withColumn("learning_rate", F.col("epoch") / 1000.0)
    tl.history_document(hist).coalesce(1).write.mode("overwrite").json(path)
    doc = spark.read.schema("train_loss array<double>, val_loss array<double>, learning_rate array<double>").json(path)
    rows = tl.history_rows(doc).withColumn("epoch", F.col("epoch").cast("bigint"))
    return rounded(rows, "train_loss", "val_loss")


@register(
    "latency_summary",
    with_views(
        f"""SELECT count(*) AS n,
       round(avg(CASE WHEN s.intent IS NOT DISTINCT FROM 'PARSE_ERROR' THEN 0.0 ELSE 1.0 END) * 100.0, 6) AS success_pct,
       round(avg(e.value), 6) AS mean_ms, min(e.value) AS min_ms, max(e.value) AS max_ms
FROM ({SINGLE}) s JOIN events e ON e.event_id = s.row_id""",
        "predictions",
    ),
)
def q_latency_summary(spark, sf_dir):
    """Success rate and timing of the scored outputs."""
    s = _single(spark, sf_dir).select("row_id", "intent")
    t = views.latencies(spark, sf_dir).select("row_id", "inference_time_ms")
    return rounded(lat.latency_summary(s.join(t, "row_id")), "success_pct", "mean_ms")


@register(
    "latency_benchmark",
    """SELECT count(*) AS n, round(avg(value), 6) AS mean_ms,
       (SELECT value FROM (SELECT value, row_number() OVER (ORDER BY value) - 1 AS k FROM events) x
        WHERE k = (SELECT count(*) // 2 FROM events)) AS median_ms,
       min(value) AS min_ms, max(value) AS max_ms, round(stddev_pop(value), 6) AS std_ms,
       round(1000.0 / avg(value), 6) AS queries_per_second
FROM events""",
)
def q_latency_benchmark(spark, sf_dir):
    """Benchmark statistics of all measured times."""
    return rounded(lat.latency_benchmark(views.latencies(spark, sf_dir)), "mean_ms", "std_ms", "queries_per_second")


@register(
    "batch_average_latency",
    "SELECT event_id // 16 AS batch_id, count(*) AS n_texts, round(sum(value), 6) AS total_ms, "
    "round(sum(value) / count(*), 6) AS avg_ms FROM events GROUP BY event_id // 16",
)
def q_batch_average_latency(spark, sf_dir):
    """Average time per text of every batch."""
    return rounded(lat.batch_average_latency(views.latencies(spark, sf_dir)), "total_ms", "avg_ms")
