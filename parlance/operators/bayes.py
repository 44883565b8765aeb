"""Intent classifier by sufficient statistics (M1-M3): multinomial naive Bayes.

The model is one table of counts, ``intent, token, n``; the row of an intent
with a null token holds its number of texts. Counts of two training sets add
up (``merged``), so a model grows with its data without a second pass over the
old ones, and training is one grouped count with partial aggregation.

Weights are whole billionths of a nat. Their sums are exact in any order, so
reruns and other partitionings decide alike; ties go to the least intent.
Tokens that training has not seen are left out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.operators.annotations import format_target

UNIT = 1e9
ALPHA = 1.0
GRID = (1.0, 0.1, 0.01)


def tokens(text: Column) -> Column:
    """Lower-cased words between blanks; none for a null text."""
    return F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda t: t != "")


def train_counts(train: DataFrame) -> DataFrame:
    """M1: the counts of ``intent, text``; rows without an intent are left out."""
    rows = train.where("intent is not null")
    # The null in front stands for the text itself.
    each = F.concat(F.array(F.lit(None).cast("string")), F.coalesce(tokens(F.col("text")), F.array().cast("array<string>")))
    return rows.select("intent", F.explode(each).alias("token")).groupBy("intent", "token").agg(F.count(F.lit(1)).alias("n"))


def merged(*counts: DataFrame) -> DataFrame:
    """The counts of the training sets taken together."""
    return reduce(DataFrame.unionByName, counts).groupBy("intent", "token").agg(F.sum("n").alias("n"))


def _whole(nats: Column) -> Column:
    return F.round(nats * F.lit(UNIT)).cast("long")


def class_weights(counts: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """``intent, prior, missing``: weight of an intent and, per known token, of one that it lacks."""
    per = counts.groupBy("intent").agg(
        F.sum(F.when(F.col("token").isNull(), F.col("n"))).alias("docs"),
        F.coalesce(F.sum(F.when(F.col("token").isNotNull(), F.col("n"))), F.lit(0)).alias("total"),
    )
    known = counts.agg(F.count_distinct("token").alias("known"))
    docs = F.sum("docs").over(Window.partitionBy())  # one row per intent
    return per.crossJoin(known).select(
        "intent",
        _whole(F.log(F.col("docs") / docs)).alias("prior"),
        _whole(F.log(F.lit(alpha)) - F.log(F.col("total") + F.lit(alpha) * F.greatest("known", F.lit(1)))).alias("missing"),
    )


def token_weights(counts: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """``token, entries``: what an occurrence adds to each intent that has the token (at most one entry per intent)."""
    w = _whole(F.log(F.col("n") + F.lit(alpha)) - F.log(F.lit(alpha)))
    return counts.where("token is not null").groupBy("token").agg(F.collect_list(F.struct("intent", w.alias("w"))).alias("entries"))


def scored(counts: DataFrame, df: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """``df`` with ``scores``: per intent of the model its score, intents in order.

    ``df`` needs ``row_id`` (one row each) and ``text``. Only (row, token) counts are
    shuffled, not the texts times the intents; a row holds one number per intent.
    """
    said = df.select("row_id", F.explode(tokens(F.col("text"))).alias("token")).groupBy("row_id", "token").agg(F.count(F.lit(1)).alias("tf"))
    met = said.join(token_weights(counts, alpha), "token").select("row_id", "tf", F.posexplode("entries").alias("at", "entry"))
    per = met.groupBy("row_id", F.col("entry.intent").alias("of")).agg(
        F.sum(F.col("tf") * F.col("entry.w")).alias("sum"), F.sum(F.when(F.col("at") == 0, F.col("tf")).otherwise(0)).alias("occurrences")
    )
    per = per.groupBy("row_id").agg(
        F.map_from_entries(F.collect_list(F.struct("of", "sum"))).alias("_sums"), F.sum("occurrences").alias("_known")
    )
    classes = class_weights(counts, alpha).agg(F.sort_array(F.collect_list(F.struct("intent", "prior", "missing"))).alias("_classes"))
    known = F.coalesce("_known", F.lit(0))
    score = F.transform(
        "_classes",
        lambda c: F.struct(
            c["intent"].alias("intent"),
            (c["prior"] + known * c["missing"] + F.coalesce(F.element_at("_sums", c["intent"]), F.lit(0))).alias("score"),
        ),
    )
    return df.join(per, "row_id", "left").crossJoin(classes).withColumn("scores", score).drop("_sums", "_known", "_classes")


def _top(scores: str = "scores") -> Column:
    return F.array_max(F.transform(scores, lambda s: s["score"]))


def predict(counts: DataFrame, df: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """M2: ``row_id, intent_pred, pred_text``; null without a trained intent."""
    best = F.get(F.filter("scores", lambda s: s["score"] == F.col("_top")), F.lit(0))["intent"]
    rows = scored(counts, df.select("row_id", "text"), alpha).withColumn("_top", _top()).withColumn("intent_pred", best)
    return rows.select("row_id", "intent_pred", format_target("intent_pred", F.lit("{}")).alias("pred_text"))


def log_loss(counts: DataFrame, df: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """One row: mean negative log probability of the true intent (intents not trained are skipped)."""
    rows = scored(counts, df.select("row_id", "text", "intent"), alpha).withColumn("_top", _top())
    own = F.get(F.filter("scores", lambda s: s["intent"] == F.col("intent")), F.lit(0))["score"]
    shares = F.aggregate("scores", F.lit(0.0), lambda a, s: a + F.exp((s["score"] - F.col("_top")) / F.lit(UNIT)))
    return rows.agg(F.avg(F.log(shares) - (own - F.col("_top")) / F.lit(UNIT)).alias("val_log_loss"))


def select_best(counts: DataFrame, val: DataFrame, grid=GRID) -> DataFrame:
    """M3: ``alpha, val_log_loss, is_best``; the least loss wins, of equal ones the first of the grid."""
    rows = [log_loss(counts, val, a).select(F.lit(i).alias("_at"), F.lit(float(a)).alias("alpha"), "val_log_loss") for i, a in enumerate(grid)]
    first = F.row_number().over(Window.orderBy(F.col("val_log_loss").asc_nulls_last(), "_at"))  # one row per candidate
    return reduce(DataFrame.unionByName, rows).select("alpha", "val_log_loss", (first == 1).alias("is_best"))
