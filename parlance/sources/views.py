"""Stand-in input views derived from the driver tables.

The reference's own utterance sheet is not public, so its shapes are rebuilt
from the driver tables (every row of them, so the work grows with the data):

* ``utterances``  from ``events``: one labelled utterance per event, with the
  annotation variants of the fixture recipe (empty list, bad JSON, object at
  top level, nesting, lists, missing id, missing params, ...).
* ``predictions`` from the training pairs: model outputs of eight kinds.
* ``latencies``, ``batch_loss``, ``history``: timing and loss logs from
  ``events``.
* ``texts`` and ``labelled_texts`` from ``documents``/``conversations``/``labels``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.config import scratch_path
from parlance.functions.json import json_quote
from parlance.sources.tables import table, write_bucketed

_WRITTEN: dict[tuple[str, str, str], str] = {}


def written(spark: SparkSession, sf_dir: str, name: str, build, bucket_by: str | None = None) -> DataFrame:
    """``build()`` written once as a Parquet table in the shared checkpoint
    folder and read back: the stored table a real pipeline would read.

    Cuts the lineage (a lost executor re-reads the table, not the whole
    derivation) and keeps downstream plans small.  One write per
    application and input folder.  With ``bucket_by`` the table is bucketed by
    that column, so tables that are joined on it need no exchange.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    path = _WRITTEN.get(key)
    if path is None:
        path = scratch_path(spark, name)
        if bucket_by is None:
            build().write.mode("overwrite").parquet(path)
        else:
            path = write_bucketed(build(), path, bucket_by)
        _WRITTEN[key] = path
    return spark.read.parquet(path) if bucket_by is None else spark.table(path)


def utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_id, transcript, intent, nli_output, frequency`` from ``events``."""
    ev = table(spark, sf_dir, "events", "event_id", "user_id", "event_type", "value", "props")
    r = F.col("event_id") % 10
    n = F.regexp_extract("props", r"([0-9]+)", 1)
    intent = (
        F.when(F.col("event_id") < 2, F.lit("RARE_PAIR"))
        .when(F.col("event_id") == 2, F.lit("RARE_ONE"))
        .otherwise(F.upper("event_type"))
    )
    # One template per r = event_id % 10; {i} intent, {n} number, {t} event
    # type, {p} the props object.  Fixed values of the fixture recipe.
    templates = [
        "[]",
        "not json",
        '{"id": "{i}", "params": {"k": {n}}}',
        '[{"id": "{i}", "params": {"k": {n}, "timer_duration": {"amount": {n}, "unit": "min"}}}]',
        '[{"id": "{i}", "params": {"tags": ["a", "b"], "label": "{t}"}}]',
        '[{"params": {"k": {n}, "on": true}}]',
        '[{"id": "{i}"}]',
        '[{"id": "{i}", "params": {}}]',
        '[{"id": "{i}", "params": {"k": "{n}"}}]',
        '[{"id": "{i}", "params": {p}}]',
    ]
    t = F.element_at(F.array(*[F.lit(x) for x in templates]), (r + 1).cast("int"))
    nli = F.replace(
        F.replace(F.replace(F.replace(t, F.lit("{i}"), intent), F.lit("{n}"), n), F.lit("{t}"), F.col("event_type")),
        F.lit("{p}"),
        F.col("props"),
    )
    transcript = F.concat(
        F.col("event_type"),
        F.lit(" request from user "),
        F.col("user_id").cast("string"),
        F.when(r == 3, F.lit(" set a timer")).otherwise(F.lit("")),
    )
    return ev.select(
        F.col("event_id").alias("row_id"),
        transcript.alias("transcript"),
        intent.alias("intent"),
        nli.alias("nli_output"),
        F.floor("value").cast("bigint").alias("frequency"),
    )


def predicted_text() -> Column:
    """Eight kinds of model output for training pairs, by ``row_id % 8``."""
    m = F.col("row_id") % 8
    ref = F.col("output_text")
    qi = json_quote(F.col("intent"))
    return (
        F.when(m == 0, ref)
        .when(m == 1, F.concat(F.lit('{"intent":"UNSUPPORTED","params":'), F.col("params"), F.lit("}")))
        .when(m == 2, F.expr("substr(output_text, 2, length(output_text) - 2)"))
        .when(m == 3, F.lit(""))
        .when(m == 4, F.concat(F.lit('{"intent":'), qi, F.lit(',"params":{}}')))
        .when(m == 5, F.concat(F.lit('{"intent":'), qi, F.lit(',"params":{"k":1,"extra":2}}')))
        .when(m == 6, F.lit("[1]"))
        .otherwise(F.concat(F.lit('{"params":'), F.col("params"), F.lit("}")))
    )


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training pairs (P5) over the ``utterances`` view."""
    from parlance.operators.annotations import preprocess

    return preprocess(utterances(spark, sf_dir))


def _evaluation_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_id, intent, ref_text, pred_text``: reference and model output of every pair, from one reading of the annotations."""
    return written(
        spark, sf_dir, "evaluation_inputs",
        lambda: pairs(spark, sf_dir).select("row_id", "intent", F.col("output_text").alias("ref_text"), predicted_text().alias("pred_text")),
        "row_id",
    )


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_id, intent, ref_text``: the stored reference output of every pair."""
    return _evaluation_inputs(spark, sf_dir).select("row_id", "intent", "ref_text")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_id, pred_text``: the stored model outputs."""
    return _evaluation_inputs(spark, sf_dir).select("row_id", "pred_text")


def truncated_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_id, raw``: outputs of a model that stopped early.

    The reference output without its opening brace and without its closing
    braces: the brace fix alone cannot settle them, so they exercise the
    regex repair and the last-resort scanner.
    """
    return written(
        spark, sf_dir, "truncated",
        lambda: pairs(spark, sf_dir).select(
            "row_id", F.regexp_replace("output_text", r"^\{|\}+$", "").alias("raw")
        ),
    )


def intent_only_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_id, raw``: outputs holding only the intent member, no braces.

    The brace fix alone settles these (the other views end in a params brace,
    which the fix leaves alone).
    """
    return pairs(spark, sf_dir).select("row_id", F.concat(F.lit('"intent":'), json_quote(F.col("intent"))).alias("raw"))


#: Damaged params and what a tolerant reader makes of them, by ``event_id`` % 10. Fixed values of the fixture recipe:
#: {n} the number of the props, {t} the event type, {c} its first three letters.
CORRUPTED = (
    ('{"k":{n} "label":"{t}"}}', '{"k":{n},"label":"{t}"}'),  # no comma
    ('{"label":{t},"k":{n}}}', '{"label":"{t}","k":{n}}'),  # no quotes
    ('{"k":{n}, note "label":"{t}"}}', '{"k":{n},"label":"{t}"}'),  # a stray word
    ('{"k":{n},"label":"{c}', '{"k":{n},"label":"{c}"}'),  # cut inside a text
    ('{"k":{n},"tags":["a","b', '{"k":{n},"tags":[]}'),  # cut inside a list
    ('{"t":{"amount":{n} "unit":"{t}"},"k":{n}}}', '{"t":{"amount":{n},"unit":"{t}"},"k":{n}}'),  # damage inside an object
    ('{"a":-1{n} "b":{n}.5 "c":true "d":null}}', '{"a":-1{n},"b":{n}.5,"c":true,"d":null}'),  # every kind of value
    ('{"k":1 "k":{n}}}', '{"k":{n}}'),  # a key twice
    ('{"on":True,"label":"{t}"}}', '{"on":"True","label":"{t}"}'),  # a word that is no constant
    ('{"label":\'{t}\',"k":{n}}}', '{"label":"\'{t}\'","k":{n}}'),  # the wrong quotes
)


def corrupted_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_id, raw``: outputs that neither braces nor patterns settle, of every kind of damage."""
    ev = table(spark, sf_dir, "events", "event_id", "event_type", "props")
    damage = F.element_at(F.array(*[F.lit(raw) for raw, _ in CORRUPTED]), (F.col("event_id") % len(CORRUPTED) + 1).cast("int"))
    filled = F.replace(F.replace(damage, F.lit("{n}"), F.regexp_extract("props", "([0-9]+)", 1)), F.lit("{t}"), F.col("event_type"))
    filled = F.replace(filled, F.lit("{c}"), F.left("event_type", F.lit(3)))
    raw = F.concat(F.lit('"intent":"'), F.upper("event_type"), F.lit('","params":'), filled)
    return ev.select(F.col("event_id").alias("row_id"), raw.alias("raw"))


def latencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_id, batch_id, inference_time_ms`` from ``events``."""
    ev = table(spark, sf_dir, "events", "event_id", "value")
    return ev.select(
        F.col("event_id").alias("row_id"),
        F.expr("event_id div 16").alias("batch_id"),
        F.col("value").alias("inference_time_ms"),
    )


def batch_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``epoch, split, step, loss``: a per-batch loss log from ``events``."""
    ev = table(spark, sf_dir, "events", "event_id", "user_id", "value")
    return ev.select(
        (F.col("event_id") % 15 + 1).alias("epoch"),
        F.when(F.col("user_id") % 2 == 0, F.lit("train")).otherwise(F.lit("val")).alias("split"),
        F.col("event_id").alias("step"),
        (F.col("value") / 100).alias("loss"),
    )


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_id, text`` from documents and conversation turns.

    Documents keep their id; conversation turns get ids after the largest
    possible document id range by ``conv_id * 1000 + turn`` offset with a sign
    flip, so both id spaces never meet.
    """
    docs = table(spark, sf_dir, "documents", "doc_id", "text").select(
        F.col("doc_id").alias("row_id"), "text"
    )
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "text").select(
        (-(F.col("conv_id") * 1000 + F.col("turn")) - 1).alias("row_id"), "text"
    )
    return docs.unionByName(turns)


def labelled_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_id, text, intent``: documents joined with their quality label as intent."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality").where(F.col("quality").isNotNull())
    intent = F.when(F.col("quality") == 1, F.lit("KEEP")).otherwise(F.lit("DROP"))
    return docs.join(labels, "doc_id").select(F.col("doc_id").alias("row_id"), "text", intent.alias("intent"))
