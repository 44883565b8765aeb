"""Strict JSON and annotation parsing, with golden rows worked out by hand."""

from pyspark.sql import functions as F

from parlance.functions.json import json_quote, strict_json
from parlance.operators.annotations import annotate, params_flag, preprocess


def test_strict_json(spark):
    cases = {
        '{"a":1}': True,
        ' {"a":1} ': True,
        '{"a":1} x': False,
        "1],[2": False,
        "[]": True,
        "not json": False,
        "": False,
        "{'a':1}": False,
        '"text"': True,
        "5": True,
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: r.ok for r in df.select("t", strict_json("t").alias("ok")).collect()}
    assert got == cases
    assert spark.range(1).select(strict_json(F.lit(None).cast("string")).alias("x")).first().x is False


def test_json_quote(spark):
    df = spark.createDataFrame([('a"b/é',), (None,)], "t string")
    got = [r.q for r in df.select(json_quote("t").alias("q")).collect()]
    assert got == ['"a\\"b/é"', "null"]


GOLDEN = [
    # (nli_output, intent, expected params text, expected output text)
    ('[{"id": "X", "params": {"k": 5}}]', "X", '{"k":5}', '{"intent":"X","params":{"k":5}}'),
    ('[{"id": "X", "params": null}]', "X", "null", '{"intent":"X","params":null}'),
    ('[{"id": "X"}]', "X", "{}", '{"intent":"X","params":{}}'),
    ("[null]", "X", "{}", '{"intent":"X","params":{}}'),
    ("[5]", "X", "{}", '{"intent":"X","params":{}}'),
    (None, "X", "{}", '{"intent":"X","params":{}}'),
    ('[{"params": {"k": 1}}]', None, '{"k":1}', '{"intent":null,"params":{"k":1}}'),
    ('[{"params": {"b": 1, "a": 2.5}}]', "Ü", '{"b":1,"a":2.5}', '{"intent":"Ü","params":{"b":1,"a":2.5}}'),
    ('[{"params": {"city": "Zürich"}}]', "W", '{"city":"Zürich"}', '{"intent":"W","params":{"city":"Zürich"}}'),
    ('{"id": "X", "params": {"k": 1}}', "X", "{}", '{"intent":"X","params":{}}'),
    ('[{"params": "text"}]', "X", '"text"', '{"intent":"X","params":"text"}'),
]


def test_preprocess_golden(spark):
    rows = [(i, "t", intent, nli, 1) for i, (nli, intent, _, _) in enumerate(GOLDEN)]
    df = spark.createDataFrame(rows, "row_id long, transcript string, intent string, nli_output string, frequency long")
    got = {r.row_id: (r.params, r.output_text, r.input_text) for r in preprocess(df).collect()}
    for i, (_, _, params, out) in enumerate(GOLDEN):
        assert got[i][0] == params, (i, got[i])
        assert got[i][1] == out, (i, got[i])
        assert got[i][2] == "nlu: t"


def test_params_flag_three_outcomes(spark):
    cases = [
        ('[{"params": {"k": 1}}]', "with"),
        ('[{"params": {}}]', "without"),
        ('[{"id": "X"}]', "without"),
        ("[5]", "without"),
        ("not json", "without"),
        ("[]", None),
        ('{"params": {"k": 1}}', None),
        ('[{"params": null}]', "without"),
    ]
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "row_id long, nli_output string")
    got = {r.row_id: r.flag for r in annotate(df).select("row_id", params_flag().alias("flag")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(cases)}


def test_duplicate_keys_last_wins(spark):
    df = spark.createDataFrame([('[{"id": "A", "id": "B", "params": {}}]',)], "nli_output string")
    row = annotate(df).first()
    assert row.a_elem_object and row.a_has_id
