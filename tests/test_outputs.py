"""Output repair golden cases (worked out from the original code) and the scanner."""

import json

from pyspark.sql import functions as F

from parlance.functions.scan import read_pairs
from parlance.operators.outputs import classify_output_issue, drop_blank_utterances, issue_summary, parse_outputs, response_record

GOLDEN_SINGLE = [
    ('{"intent": "SET_TIMER", "params": {"timer_duration": {"amount": 5, "unit": "min"}}}', "strict", "SET_TIMER",
     {"timer_duration": {"amount": 5, "unit": "min"}}),
    ('"intent": "JOKE"', "braces", "JOKE", None),
    ('"intent": "JOKE", "params": {}', "regex", "JOKE", {}),
    ('"intent": "SET_VOLUME", "params": "level": 50', "regex", "SET_VOLUME", {"level": 50}),
    ('"intent": "SET_TIMER", "params": "timer_duration": "amount": 5, "unit": "min"', "scan", "SET_TIMER",
     {"timer_duration": "amount", "unit": "min"}),
    ('"intent": "X", "params": {"a": {"b": 1}', "scan", "X", {"a": {"b": 1}}),
    ("hello", "sentinel", "PARSE_ERROR", {}),
    ("", "sentinel", "PARSE_ERROR", {}),
]


def test_single_mode_golden(spark):
    df = spark.createDataFrame([(i, t) for i, (t, *_) in enumerate(GOLDEN_SINGLE)], "row_id long, raw string")
    got = {r.row_id: r for r in parse_outputs(df, "raw", "single").collect()}
    for i, (raw, settled, intent, params) in enumerate(GOLDEN_SINGLE):
        r = got[i]
        assert r.settled_by == settled, (raw, r)
        assert r.intent == intent, (raw, r)
        if params is None:
            assert r.params is None
        else:
            assert json.loads(r.params) == params, (raw, r.params)
        if settled == "sentinel":
            assert r.raw_output == raw and r.error is not None
        else:
            assert r.raw_output is None


def test_non_object_and_batch_mode(spark):
    df = spark.createDataFrame([(0, "[1]"), (1, "hello"), (2, '{"intent": "A", "params": {"on": true}}')], "row_id long, raw string")
    single = {r.row_id: r for r in response_record(parse_outputs(df, "raw", "single")).collect()}
    assert single[0].resp_intent == "ERROR" and single[0].resp_params == {}
    assert single[2].resp_params == {"on": "True"}
    batch = {r.row_id: r for r in parse_outputs(df, "raw", "batch").collect()}
    assert batch[1].intent == "UNSUPPORTED" and batch[1].raw_output == "hello" and batch[1].params == "{}"
    fb = {r.row_id: r for r in parse_outputs(df, "raw", "fallback").collect()}
    assert fb[1].intent == "PARSE_ERROR"


def test_fallback_pattern(spark):
    df = spark.createDataFrame([(0, '"intent": "PLAY_MUSIC", "params": {')], "row_id long, raw string")
    r = parse_outputs(df, "raw", "fallback").first()
    assert (r.intent, r.params) == ("PLAY_MUSIC", "{}")


def test_scanner_pure():
    assert read_pairs('{"a": [1, 2], "b": true, "c": null, "d": -2.5, "e": x}') == {
        "a": [1, 2], "b": True, "c": None, "d": -2.5, "e": "x"
    }
    assert read_pairs('"k": "unclosed') == {"k": "unclosed"}
    assert read_pairs('"k": [1, 2') == {"k": []}


def test_scanner_runs_only_on_failing_rows(spark):
    df = spark.createDataFrame([(0, '{"intent": "A"}')], "row_id long, raw string")
    parsed = parse_outputs(df, "raw", "single")
    for rows in (parsed, parsed.where("settled_by = 'scan'"), parsed.where("settled_by = 'sentinel'")):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        # One Arrow node, which gets one text of the failing rows and null of the others; nothing is written.
        assert plan.count("ArrowEvalPython [") == 1 and "MapInArrow" not in plan and "Exchange" not in plan
        assert "scan_texts(CASE WHEN (_try14" in plan and "FileScan" not in plan


def test_unreadable_rows_end_at_the_sentinel(spark):
    bad = ['"intent": "A", "params": {"n": ' + "9" * 5000 + ", x", '"intent": "A", "params": ' + '{"a":' * 2000]
    df = spark.createDataFrame([*enumerate(bad), (2, '"intent": "X", "params": {"a": {"b": 1}')], "row_id long, raw string")
    got = {r.row_id: r for r in parse_outputs(df, "raw", "single").collect()}
    assert [got[i].settled_by for i in range(3)] == ["sentinel", "sentinel", "scan"]
    assert got[0].intent == got[1].intent == "PARSE_ERROR" and got[1].raw_output == bad[1]


def test_scanner_reads_long_and_deep_texts():
    deep = read_pairs('"a": {' * 900 + '"x": 1')
    for _ in range(900):
        deep = deep["a"]
    assert deep == {"x": 1}
    assert len(read_pairs(", ".join(f'"k{i}": {{"v": [{i}]}}' for i in range(20_000)))) == 20_000
    assert read_pairs('"a": 1, "a": 2') == {"a": 2}


def test_fallback_defaults(spark):
    rows = [(0, '{"params": {"k": 1}}'), (1, '{"intent": "A"}'), (2, "nothing")]
    got = {r.row_id: r for r in parse_outputs(spark.createDataFrame(rows, "row_id long, raw string"), "raw", "fallback").collect()}
    assert (got[0].intent, got[1].params) == ("N/A", "{}")
    assert [got[i].raw_output for i in range(3)] == [r[1] for r in rows]
    assert [got[i].error is None for i in range(3)] == [True, True, False]


def test_error_record_has_no_time(spark):
    df = spark.createDataFrame([(0, "[1]", 12.5), (1, '{"intent": "A"}', 12.5)], "row_id long, raw string, ms double")
    got = {r.row_id: r.inference_time_ms for r in response_record(parse_outputs(df, "raw", "single"), F.col("ms")).collect()}
    assert got == {0: 0.0, 1: 12.5}


def test_unicode_blanks_and_falsy_numbers(spark):
    texts = spark.createDataFrame([(0, "\u00a0\u2003"), (1, " \x1c"), (2, "x\u00a0"), (3, ""), (4, None)], "row_id long, text string")
    assert [r.row_id for r in drop_blank_utterances(texts).collect()] == [2]
    rows = [(i, f'{{"intent": "A", "params": {p}}}', "set a timer") for i, p in enumerate(("0.0", "-0", "0e5", "0.5", "{}", '{"a": 1}'))]
    parsed = parse_outputs(spark.createDataFrame(rows, "row_id long, raw string, transcript string"), "raw", "single")
    got = {r.row_id: r.issue for r in classify_output_issue(parsed).collect()}
    assert got == {0: "missing_params", 1: "missing_params", 2: "missing_params", 3: "ok", 4: "missing_params", 5: "ok"}


def test_summary_of_no_rows(spark):
    empty = spark.createDataFrame([], "issue string")
    assert {(r.n, r.pct) for r in issue_summary(empty).collect()} == {(0, None)}
