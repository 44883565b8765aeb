"""Training-log analytics.

The loss log has one row per batch; everything per epoch is a tiny table
(one row per epoch), so windows ordered by epoch are cheap there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parlance.config import DEFAULT

# Thresholds of the original diagnosis script.
HIGH_LOSS, MODERATE_LOSS = 1.0, 0.5
OVERFIT_GAP, GOOD_GAP = 0.5, 0.3
PLATEAU_DELTA = 0.01
PARSE_ERROR_LIMIT, MISSING_PARAMS_LIMIT = 30.0, 20.0


def epoch_mean_loss(batch_loss: DataFrame) -> DataFrame:
    """Unweighted mean of batch losses per (epoch, split)."""
    return batch_loss.groupBy("epoch", "split").agg(
        F.avg("loss").alias("mean_loss"), F.count(F.lit(1)).alias("n_batches")
    )


def history(epoch_means: DataFrame) -> DataFrame:
    """One row per epoch: ``epoch, train_loss, val_loss``."""
    return epoch_means.groupBy("epoch").agg(
        F.max(F.when(F.col("split") == "train", F.col("mean_loss"))).alias("train_loss"),
        F.max(F.when(F.col("split") == "val", F.col("mean_loss"))).alias("val_loss"),
    )


def _epochs() -> Window:
    return Window.partitionBy(F.lit(0)).orderBy("epoch")


def running_best_loss(hist: DataFrame, save_every: int | None = None) -> DataFrame:
    """Best validation loss before each epoch, ``is_best`` on strict
    improvement (the first epoch always improves), periodic checkpoint flag."""
    k = DEFAULT.save_every if save_every is None else save_every
    before = F.min("val_loss").over(_epochs().rowsBetween(Window.unboundedPreceding, -1))
    return hist.select(
        "epoch",
        "val_loss",
        before.alias("best_before"),
        (before.isNull() | (F.col("val_loss") < before)).alias("is_best"),
        F.least(F.coalesce(before, F.col("val_loss")), F.col("val_loss")).alias("best_so_far"),
        ((F.col("epoch") % k) == 0).alias("save_checkpoint"),
    )


def loss_delta(hist: DataFrame) -> DataFrame:
    """Last minus previous train loss and its reading (more than two epochs only)."""
    w = _epochs()
    last = hist.select(
        "epoch",
        (F.col("train_loss") - F.lag("train_loss").over(w)).alias("delta"),
        F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))).alias("n_epochs"),
        F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("epoch").desc())).alias("_r"),
    ).where(F.col("_r") == 1)
    status = (
        F.when(F.col("n_epochs") <= 2, F.lit(None))
        .when(F.abs("delta") < PLATEAU_DELTA, F.lit("plateau"))
        .when(F.col("delta") > 0, F.lit("increased"))
        .otherwise(F.lit("decreasing"))
    )
    return last.select(
        "n_epochs",
        F.when(F.col("n_epochs") > 2, F.col("delta")).alias("last_delta"),
        status.alias("status"),
    )


def generalization_gap(hist: DataFrame) -> DataFrame:
    """Val minus train per epoch with its reading."""
    gap = F.col("val_loss") - F.col("train_loss")
    status = F.when(gap > OVERFIT_GAP, "overfitting").when(gap < GOOD_GAP, "good").otherwise("ok")
    return hist.select("epoch", gap.alias("gap"), status.alias("status"))


def final_gap(hist: DataFrame) -> DataFrame:
    """Gap of the last epoch."""
    return hist.agg(
        F.max("epoch").alias("epoch"),
        F.max_by(F.col("val_loss") - F.col("train_loss"), "epoch").alias("final_gap"),
    )


def diagnosis_flags(hist: DataFrame, issues: DataFrame) -> DataFrame:
    """Loss band of the final validation loss and the issue-rate flags."""
    last = hist.agg(F.max_by("val_loss", "epoch").alias("final_val_loss"))
    rates = issues.agg(
        F.max(F.when(F.col("issue") == "json_parse_error", F.col("pct"))).alias("parse_error_pct"),
        F.max(F.when(F.col("issue") == "missing_params", F.col("pct"))).alias("missing_params_pct"),
    )
    band = (
        F.when(F.col("final_val_loss") > HIGH_LOSS, "high")
        .when(F.col("final_val_loss") > MODERATE_LOSS, "moderate")
        .otherwise("low")
    )
    return last.crossJoin(rates).select(
        "final_val_loss",
        band.alias("loss_band"),
        "parse_error_pct",
        (F.col("parse_error_pct") > PARSE_ERROR_LIMIT).alias("high_parse_error"),
        "missing_params_pct",
        (F.col("missing_params_pct") > MISSING_PARAMS_LIMIT).alias("missing_params_issue"),
    )


def history_document(hist: DataFrame) -> DataFrame:
    """S8 sink side: one row with an array per metric (losses, learning rate), ordered by epoch (epochs are few)."""
    metrics = [c for c in hist.columns if c != "epoch"]
    rows = F.array_sort(F.collect_list(F.struct("epoch", *metrics)))
    return hist.agg(rows.alias("_r")).select(*(F.col(f"_r.{c}").alias(c) for c in metrics))


def history_rows(doc: DataFrame) -> DataFrame:
    """S8 scan side: arrays per metric back to one row per epoch."""
    z = doc.select(F.posexplode(F.arrays_zip(*doc.columns)).alias("pos", "z"))
    return z.select((F.col("pos") + 1).alias("epoch"), *(F.col(f"z.{c}").alias(c) for c in doc.columns))
