"""Intent classifier with Spark ML (M1-M4), in place of the neural model.

Text -> tokens -> hashed term frequencies -> IDF -> multinomial logistic
regression; predictions are written as ``{"intent": ..., "params": {}}``.
The candidate with the lowest validation log-loss is kept (the original
kept the checkpoint with the lowest validation loss). A null text has no tokens.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, IndexToString, RegexTokenizer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.operators.annotations import format_target


def intent_pipeline(reg_param: float = 0.0, num_features: int = 1 << 16, max_iter: int = 30) -> Pipeline:
    """M1: the estimator (fit on the train split)."""
    return Pipeline(
        stages=[
            RegexTokenizer(inputCol="text", outputCol="_tokens", pattern=r"\s+", toLowercase=True),
            HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=num_features),
            IDF(inputCol="_tf", outputCol="_features"),
            StringIndexer(inputCol="intent", outputCol="_label", handleInvalid="keep"),
            LogisticRegression(featuresCol="_features", labelCol="_label", maxIter=max_iter, regParam=reg_param, family="multinomial"),
        ]
    )


def _with_text(df: DataFrame, column: str) -> DataFrame:
    """``column, text`` as the pipeline reads them: its tokenizer fails on null, so a null text is an empty one."""
    return df.select(column, F.coalesce("text", F.lit("")).alias("text"))


def train_intent_classifier(train: DataFrame, reg_param: float = 0.0) -> PipelineModel:
    """M1: fit on ``text, intent``."""
    return intent_pipeline(reg_param).fit(_with_text(train, "intent"))


def predict_intents(model: PipelineModel, df: DataFrame) -> DataFrame:
    """M2: ``row_id, intent_pred, pred_text`` with ``pred_text`` as the model's JSON.

    The likeliest intent of the train rows, the first of equal ones. The class
    that the indexer keeps for unseen intents comes last, has no name and is
    never predicted, whatever the model extrapolates for it.
    """
    labels = model.stages[3].labels
    scored = model.transform(_with_text(df, "row_id"))
    learnt = scored.withColumn("_raw", F.slice(vector_to_array("rawPrediction"), 1, len(labels)))
    likeliest = learnt.withColumn("prediction", (F.array_position("_raw", F.array_max("_raw")) - 1).cast("double"))
    named = IndexToString(inputCol="prediction", outputCol="intent_pred", labels=labels).transform(likeliest)
    return named.select("row_id", "intent_pred", format_target("intent_pred", F.lit("{}")).alias("pred_text"))


def log_loss(model: PipelineModel, df: DataFrame) -> float:
    """Mean negative log probability of the true intent (unknown intents skipped)."""
    scored = model.transform(_with_text(df, "intent"))
    n_labels = len(model.stages[3].labels)
    p = F.element_at(vector_to_array("probability"), (F.col("_label") + 1).cast("int"))
    return scored.where(F.col("_label") < n_labels).agg(F.avg(-F.log(F.greatest(p, F.lit(1e-15))))).first()[0]


def select_best_model(train: DataFrame, val: DataFrame, grid=(0.0, 0.01, 0.1)):
    """M3: fit one model per regularisation value, keep the lowest val log-loss.

    Returns ``(model, table)``; the table has one row per candidate with its
    loss and ``is_best`` (exactly one: the first of the lowest loss).
    """
    rows = []
    best, kept = None, None
    for reg in grid:
        m = train_intent_classifier(train, reg)
        loss = log_loss(m, val)
        improved = best is None or loss < best[1]
        if improved:
            best, kept = (m, loss), len(rows)
        rows.append((float(reg), float(loss)))
    spark = train.sparkSession
    marked = [(*r, i == kept) for i, r in enumerate(rows)]
    return best[0], spark.createDataFrame(marked, "reg_param double, val_log_loss double, is_best boolean")


def model_roundtrip(model: PipelineModel, path: str) -> PipelineModel:
    """M4: save and load again."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path)
