"""Model-output parsing, repair and response shaping.

``parse_outputs(df, text, mode)`` turns raw model text into a result record:

* ``single``   strict JSON; else add missing outer braces (P13); else take the
  intent and params by pattern, trim and balance braces (P14); else read the
  params text with the last-resort scanner (P15, Python, only those rows);
  else the sentinel ``PARSE_ERROR`` with the raw text and an error (P16).
  A repair result that is an empty object counts as a failure.
* ``batch``    strict JSON, else ``UNSUPPORTED`` with the raw text; no repair.
* ``fallback`` strict JSON, where an object without intent has ``N/A`` and one
  without params ``{}``; else the intent by pattern or ``PARSE_ERROR``, params
  ``{}`` and an error. The raw text is on every row (P12).

Output columns: ``settled_by`` (strict, braces, regex, scan, sentinel),
``result`` (JSON text of the result value), ``is_object``, ``intent``,
``has_intent``, ``params`` (JSON text, null when the key is missing),
``raw_output`` and ``error`` (null unless set).
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions import scan
from parlance.functions.json import json_quote, strict_json, variant_kind

# Patterns and sentinels of the original output handling.
INTENT_PATTERN = r'"intent":\s*"([^"]+)"'
PARAMS_PATTERN = r'(?s)"params":\s*(.+?)(?:$|(?="intent"))'
PARSE_ERROR = "PARSE_ERROR"
UNSUPPORTED = "UNSUPPORTED"
UNKNOWN = "UNKNOWN"
ERROR = "ERROR"
PARSE_ERROR_MESSAGE = "invalid JSON"
NO_INTENT = "N/A"


# The scanner module travels with the UDF (pickled by value), so executors
# need only pyarrow, not this package on their path.
cloudpickle.register_pickle_by_value(scan)


def _strip(c: Column) -> Column:
    """Without white space at both ends, as Python's ``strip`` has it (Unicode too)."""
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def _count(c: Column, ch: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(ch), F.lit("")))


def _members(result: Column) -> dict[str, Column]:
    """Facts of a strict JSON result text."""
    obj = F.coalesce(F.ltrim(result).startswith("{"), F.lit(False))
    keys = F.json_object_keys(result)
    has_intent = obj & F.coalesce(F.array_contains(keys, "intent"), F.lit(False))
    has_params = obj & F.coalesce(F.array_contains(keys, "params"), F.lit(False))
    members = F.from_json(result, "struct<intent:string,params:string>")
    pv = F.try_variant_get(F.try_parse_json(result), "$.params", "variant")
    pkind = variant_kind(pv)
    params = (
        F.when(~has_params, F.lit(None))
        .when(pkind == "NULL", F.lit("null"))
        .when(pkind == "STRING", json_quote(members["params"]))
        .otherwise(members["params"])
    )
    return {
        "is_object": obj,
        "has_intent": has_intent,
        "intent": F.when(obj, members["intent"]),
        "params": F.when(obj, params),
    }


def parse_outputs(df: DataFrame, text: str = "raw", mode: str = "single") -> DataFrame:
    """Add the result record of each raw model output (see module doc)."""
    if mode not in ("single", "batch", "fallback"):
        raise ValueError(f"unknown mode {mode!r}")
    t = F.col(text)
    base = df.withColumn("_ok0", strict_json(t))
    if mode == "single":
        base = _repair_stages(base, t)
    else:
        base = base.withColumn("_result", F.when(F.col("_ok0"), t)).withColumn(
            "_settled", F.when(F.col("_ok0"), F.lit("strict"))
        )
    m = _members(F.col("_result"))
    out = base.withColumns(
        {
            "settled_by": F.coalesce(F.col("_settled"), F.lit("sentinel")),
            "is_object": F.when(F.col("_result").isNull(), F.lit(True)).otherwise(m["is_object"]),
            "has_intent": F.when(F.col("_result").isNull(), F.lit(True)).otherwise(m["has_intent"]),
            "intent": m["intent"],
            "params": m["params"],
        }
    )
    failed = F.col("_result").isNull()
    if mode == "single":
        sentinel_intent, sentinel_error = F.lit(PARSE_ERROR), F.lit(PARSE_ERROR_MESSAGE)
    elif mode == "batch":
        sentinel_intent, sentinel_error = F.lit(UNSUPPORTED), F.lit(None).cast("string")
    else:
        found = F.regexp_extract(t, INTENT_PATTERN, 1)
        sentinel_intent = F.when(found != "", found).otherwise(F.lit(PARSE_ERROR))
        sentinel_error = F.lit(PARSE_ERROR_MESSAGE)
        out = out.withColumns(
            {
                "intent": F.when(F.col("is_object") & ~F.col("has_intent"), F.lit(NO_INTENT)).otherwise(F.col("intent")),
                "params": F.when(F.col("is_object"), F.coalesce("params", F.lit("{}"))),
            }
        )
    keep_raw = failed | F.lit(mode == "fallback")
    out = out.withColumns(
        {
            "intent": F.when(failed, sentinel_intent).otherwise(F.col("intent")),
            "params": F.when(failed, F.lit("{}")).otherwise(F.col("params")),
            "raw_output": F.when(keep_raw, t),
            "error": F.when(failed, sentinel_error),
            "result": F.coalesce(
                F.col("_result"),
                F.concat(F.lit('{"intent":'), json_quote(sentinel_intent), F.lit(',"params":{}}')),
            ),
        }
    )
    return out.drop("_ok0", "_result", "_settled")


def _repair_stages(base: DataFrame, t: Column) -> DataFrame:
    """P13 and P14 natively; P15 in Python for the rows still failing.

    One stateless plan, for batches and streams alike. Each step is a column of
    its own, so that a later step refers to the earlier one instead of repeating
    its regex chain. The steps see null where an earlier one settled the row:
    strict texts skip them all, and Python gets only texts to be scanned.
    """
    c = F.col
    base = base.withColumn("_t", F.when(~c("_ok0"), t))
    base = base.withColumn("_opened", F.when(_strip(c("_t")).startswith("{"), c("_t")).otherwise(F.concat(F.lit("{"), c("_t"))))
    base = base.withColumn("_t13", F.when(_strip(c("_opened")).endswith("}"), c("_opened")).otherwise(F.concat(c("_opened"), F.lit("}"))))
    base = base.withColumn("_ok13", strict_json(c("_t13")))
    # The P13 result must be truthy: a strict text wrapped in braces is an
    # object, falsy only when it has no keys.
    base = base.withColumn("_empty13", c("_ok13") & (F.coalesce(F.size(F.json_object_keys(c("_t13"))), F.lit(0)) == 0))
    base = base.withColumn("_t14", F.when(~c("_ok13"), c("_t")))
    base = base.withColumns({"_intent14": F.regexp_extract("_t14", INTENT_PATTERN, 1), "_ptext": F.regexp_extract("_t14", PARAMS_PATTERN, 1)})
    base = base.withColumn("_p1", F.regexp_replace(F.regexp_replace(F.regexp_replace(_strip(c("_ptext")), '"+$', ""), ",+$", ""), r"\s+$", ""))
    base = base.withColumn("_p2", F.when(c("_p1").startswith("{"), c("_p1")).otherwise(F.concat(F.lit("{"), c("_p1"))))
    missing = F.greatest(_count(c("_p2"), "{") - _count(c("_p2"), "}"), F.lit(0))
    base = base.withColumn("_p14", F.when(c("_p2").endswith("}"), c("_p2")).otherwise(F.concat(c("_p2"), F.repeat(F.lit("}"), missing))))
    base = base.withColumns({"_try14": F.coalesce(c("_intent14") != "", F.lit(False)), "_has_p14": c("_ptext") != ""})
    base = base.withColumn("_ok14", c("_try14") & (~c("_has_p14") | strict_json(c("_p14"))))
    # Not deterministic to the optimizer: a filter on the result must not scan a second time.
    scanned = F.arrow_udf(scan.scan_texts, "string").asNondeterministic()(F.when(c("_try14") & ~c("_ok14"), c("_p14")))
    base = base.withColumn("_scan", scanned)
    # A row that the scanner could not read ends at the sentinel.
    read14 = F.when(c("_ok14"), F.when(c("_has_p14"), c("_p14")).otherwise(F.lit("{}"))).otherwise(c("_scan"))
    repaired = F.concat(F.lit('{"intent":'), json_quote(c("_intent14")), F.lit(',"params":'), read14, F.lit("}"))
    full13 = c("_ok13") & ~c("_empty13")
    result = F.when(c("_ok0"), t).when(full13, c("_t13")).when(c("_try14"), repaired)
    settled = (
        F.when(c("_ok0"), F.lit("strict")).when(full13, F.lit("braces"))
        .when(c("_ok14"), F.lit("regex")).when(c("_scan").isNotNull(), F.lit("scan"))
    )
    return base.withColumns({"_result": result, "_settled": settled}).drop(
        "_t", "_opened", "_t13", "_ok13", "_empty13", "_t14", "_intent14", "_ptext", "_p1", "_p2", "_p14", "_try14", "_has_p14", "_ok14", "_scan"
    )


def params_to_string_map(params_json: Column) -> Column:
    """P10: top-level params as ``map<string,string>``: objects and lists as
    compact JSON, strings as text, ``True``/``False``/``None`` as Python
    prints them, numbers as text.  Null unless ``params`` is an object.
    """
    raw = F.from_json(params_json, "map<string,string>")
    typed = F.try_variant_get(F.try_parse_json(params_json), "$", "map<string,variant>")

    def fix(k, r, v):
        kind = variant_kind(v)
        return (
            F.when(kind == "BOOLEAN", F.when(r == "true", F.lit("True")).otherwise(F.lit("False")))
            .when(kind == "NULL", F.lit("None"))
            .otherwise(r)
        )

    is_obj = F.coalesce(F.ltrim(params_json).startswith("{"), F.lit(False))
    return F.when(is_obj, F.map_zip_with(raw, typed, fix))


def retype_string_params(m: Column) -> Column:
    """Each map value as JSON: itself if it parses strictly, else quoted."""
    return F.transform_values(m, lambda k, v: F.when(strict_json(v), v).otherwise(json_quote(v)))


def response_record(parsed: DataFrame, time_ms: Column | None = None) -> DataFrame:
    """Intent (``UNKNOWN`` when missing, ``ERROR`` when the result is not an
    object), params as a string map, optional raw output and error, time (0 for ``ERROR``)."""
    intent = (
        F.when(~F.col("is_object"), F.lit(ERROR))
        .when(~F.col("has_intent"), F.lit(UNKNOWN))
        .otherwise(F.coalesce(F.col("intent"), F.lit("")))
    )
    pmap = F.when(F.col("is_object"), F.coalesce(params_to_string_map(F.col("params")), F.create_map().cast("map<string,string>")))
    pmap = F.coalesce(pmap, F.create_map().cast("map<string,string>"))
    error = F.when(~F.col("is_object"), F.lit("result is not an object")).otherwise(F.col("error"))
    t = F.when(~F.col("is_object"), F.lit(0.0)).otherwise(time_ms if time_ms is not None else F.lit(0.0)).cast("float")
    return parsed.withColumns(
        {
            "resp_intent": intent,
            "resp_params": pmap,
            "resp_raw_output": F.col("raw_output"),
            "resp_error": error,
            "inference_time_ms": t,
        }
    )


def map_as_text(m: Column) -> Column:
    """Sorted ``key=value`` pairs joined by ``;`` (for comparison and display)."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")


def drop_blank_utterances(df: DataFrame, text: str = "text") -> DataFrame:
    """rows whose text is not empty after stripping whitespace (Unicode blanks too)."""
    return df.where(F.coalesce(~F.col(text).rlike(r"(?U)^[\s\x1c-\x1f]*$"), F.lit(False)))


# The issue kinds of the original diagnosis, in its order.
ISSUE_KINDS = ["json_parse_error", "wrong_intent", "missing_params", "ok"]
BAD_INTENTS = ["UNSUPPORTED", "PARSE_ERROR", "UNKNOWN"]


def classify_output_issue(parsed: DataFrame, utterance: str = "transcript") -> DataFrame:
    """first match of parse failure, bad intent, missing params for a
    timer utterance, else ok."""
    intent = F.when(F.col("has_intent"), F.col("intent")).otherwise(F.lit(UNKNOWN))
    # What Python counts as false: empty containers and texts, null, false and zero in any spelling.
    no_params = (
        F.col("params").isNull()
        | F.col("params").isin("{}", "[]", '""', "null", "false")
        | F.col("params").rlike(r"^-?0+(\.0*)?([eE][+-]?\d+)?$")
    )
    issue = (
        F.when(F.col("raw_output").isNotNull() | F.col("error").isNotNull() | ~F.col("is_object"), F.lit("json_parse_error"))
        .when(intent.isin(*BAD_INTENTS), F.lit("wrong_intent"))
        .when(no_params & F.lower(F.col(utterance)).contains("timer"), F.lit("missing_params"))
        .otherwise(F.lit("ok"))
    )
    return parsed.withColumn("issue", issue)


def issue_summary(classified: DataFrame) -> DataFrame:
    """Count and percent of all rows per issue kind; kinds with no rows kept; null percent of no rows."""
    spark = classified.sparkSession
    kinds = spark.createDataFrame([(k,) for k in ISSUE_KINDS], "issue string")
    counts = classified.groupBy("issue").agg(F.count(F.lit(1)).alias("n"))
    total = classified.agg(F.count(F.lit(1)).alias("total"))
    return (
        kinds.join(counts, "issue", "left")
        .crossJoin(total)
        .select(
            "issue",
            F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"),
            F.try_divide(F.coalesce(F.col("n"), F.lit(0)) * F.lit(100.0), F.col("total").cast("double")).alias("pct"),
        )
    )


def zip_texts_with_predictions(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Request texts and response items matched by (request, position)."""
    t = requests.select("request_id", F.posexplode("texts").alias("position", "text"))
    p = responses.select("request_id", F.posexplode("predictions").alias("position", "prediction"))
    return t.join(p, ["request_id", "position"], "inner")
