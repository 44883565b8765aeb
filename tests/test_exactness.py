"""Inputs the derived views lack: no cap, no rounding before a decision, missing values, shared folders."""

from types import SimpleNamespace

import pytest

from parlance import config
from parlance.operators import annotations, evaluate, latency, profile, schema_mining, splits, training_log


def nested(depth, leaf):
    return '{"intent":"A","params":' + '{"a":' * depth + str(leaf) + "}" * depth + "}"


def counts(spark, rows):
    aligned = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row_id long, pred_text string, ref_text string")
    return tuple(evaluate.param_counts(aligned).first())


@pytest.mark.parametrize("depth", [8, 9, 20])
def test_deep_leaves_are_compared(spark, depth):
    assert counts(spark, [(nested(depth, 1), nested(depth, 2)), (nested(depth, 3), nested(depth, "3.0"))]) == (1, 2, 2)


def test_values_compare_exactly(spark):
    pair = lambda a, b: tuple(f'{{"params":{{"k":{x}}}}}' for x in (a, b))
    big = [pair("9007199254740993", "9007199254740992"), pair("9007199254740992", "9007199254740992.0"), pair("true", "1"), pair("5", "5.0"), pair("null", "null"), pair('"5"', "5")]
    assert counts(spark, big) == (4, 6, 6)


def params(text):
    return f'{{"params":{text}}}'


@pytest.mark.parametrize(
    ("pred", "ref", "want"),
    [
        ('{"a.b":1,"a":{"b":2}}', '{"a":{"b":2}}', (1, 1, 1)),  # of one path the later leaf counts
        ('{"a":{"b":2},"a.b":1}', '{"a":{"b":2}}', (0, 1, 1)),
        ('{"a":{"b":2},"a.b":1}', '{"a.b":1}', (1, 1, 1)),
        ('{"k":[1,2.0]}', '{"k":[1,2]}', (0, 1, 1)),  # lists compare as Python writes them
        ('{"k":[1,2]}', '{"k":[ 1 , 2 ]}', (1, 1, 1)),
        ('{"k":[{"x":1,"y":2}]}', '{"k":[{"y":2,"x":1}]}', (0, 1, 1)),
        ('{"k":"[1]"}', '{"k":[1]}', (1, 1, 1)),
        ('{"k":' + "1" * 41 + "2}", '{"k":' + "1" * 41 + "3}", (0, 1, 1)),
        ('{"k":1e19}', '{"k":10000000000000000000}', (1, 1, 1)),
        ('{"k":0.1}', '{"k":0.10}', (1, 1, 1)),
        ('{"k":NaN}', '{"k":NaN}', (0, 1, 1)),
        ('{"k":Infinity}', '{"k":1e999}', (1, 1, 1)),
        ('{"k":1,"k":2}', '{"k":2}', (1, 1, 1)),
        ('{"a":{},"":{"b":1}}', '{"b":1}', (1, 1, 1)),
        ('{"k":"\\ud800"}', '{"k":"\\ud800"}', (1, 1, 1)),
        ('{"k":' + "9" * 5000 + "}", '{"k":1}', (0, 0, 0)),  # beyond Python's digit limit: not read
        ("[]", "{}", (0, 0, 0)),
    ],
)
def test_leaves_compare_as_python_has_them(spark, pred, ref, want):
    rows = [(7, params(pred), params(ref)), (7, params(pred), params(ref)), (7, None, params(ref)), (8, params("1"), params(ref))]
    aligned = spark.createDataFrame(rows, "row_id long, pred_text string, ref_text string")
    # A repeated row_id counts each time; a pair without params on one side counts for nothing.
    assert tuple(evaluate.param_counts(aligned).first()) == tuple(2 * n for n in want)
    matched = evaluate.matched_leaves(aligned).collect()
    assert [sum(f(r) for r in matched) for f in (lambda r: r.equal, lambda r: r.pkey is not None, lambda r: r.rkey is not None)] == [2 * n for n in want]
    flat = evaluate.flatten_params(aligned, ["row_id"], "ref_text").collect()
    assert len(flat) == (4 if want != (0, 0, 0) else len(flat)) and {r.vkey for r in flat} == {r.rkey for r in matched if r.rkey} or want == (0, 0, 0)


def test_building_a_comparison_runs_nothing(spark):
    aligned = spark.createDataFrame([(0, nested(3, 1), nested(3, 1))], "row_id long, pred_text string, ref_text string")
    aligned = evaluate.align_predictions(aligned.select("row_id", "pred_text"), aligned.select("row_id", "ref_text"))
    spark.sparkContext.setJobGroup("plans only", "")
    try:
        for build in (evaluate.param_counts, evaluate.matched_leaves, evaluate.evaluation_report):
            build(aligned)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("plans only")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = evaluate.evaluation_report(aligned)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1


def test_no_join_between_the_sides(spark):
    aligned = spark.createDataFrame([(0, nested(1, 1), nested(1, 1))], "row_id long, pred_text string, ref_text string")
    assert "Join" not in evaluate.param_counts(aligned)._jdf.queryExecution().executedPlan().toString()


def test_losses_decide_unrounded(spark):
    hist = spark.createDataFrame([(1, 1.0, 0.5000004), (2, 1.0, 0.5000001)], "epoch long, train_loss double, val_loss double")
    assert [r.is_best for r in training_log.running_best_loss(hist).orderBy("epoch").collect()] == [True, True]
    tiny = spark.createDataFrame([(1, "train", 4e-11), (1, "train", 4e-11), (1, "val", 1e30)], "epoch long, split string, loss double")
    assert {r.mean_loss for r in training_log.epoch_mean_loss(tiny).collect()} == {4e-11, 1e30}
    doc = training_log.history_document(hist.selectExpr("*", "0.1 as learning_rate"))
    assert training_log.history_rows(doc).columns == ["epoch", "train_loss", "val_loss", "learning_rate"]


def test_mean_length_decides_unrounded(spark):
    df = spark.range(0, 3_000_000, 1, 8).selectExpr("if(id = 0, 'abcdefghijk', 'abcdefghij') as t")
    assert [r.column_name for r in profile.text_column_profile(df).collect()] == ["t"]


def test_nan_is_missing_and_zero_is_one_value(spark):
    nan = float("nan")
    df = spark.createDataFrame([(nan,), (1.0,), (2.0,), (0.0,), (-0.0,), (None,)], "x double")
    assert profile.null_counts(df).first().n_null == 2
    assert profile.distinct_counts(df).first().n_distinct == 3
    d = profile.numeric_describe(df).first()
    assert (d["count"], d["mean"], d["p50"], d["max"]) == (4, 0.75, 0.5, 2.0)


def test_mean_of_zero_has_no_rate(spark):
    r = latency.latency_benchmark(spark.createDataFrame([(0.0,), (0.0,)], "inference_time_ms double")).first()
    assert r.queries_per_second is None and r.mean_ms == 0


def test_params_that_are_no_object_are_reported(spark):
    cells = ['[{"params": "x"}]', '[{"params": null}]', '[{"params": [1]}]', '[{"params": {}}]', "[{}]", "[1]", "no"]
    got = annotations.quarantine_bad_rows(spark.createDataFrame([*enumerate(cells)], "row_id long, nli_output string")).collect()
    assert {r.row_id: r.reason for r in got} == {0: "bad_params", 1: "bad_params", 2: "bad_params", 5: "bad_element", 6: "bad_json"}


def test_a_cluster_without_a_shared_folder_is_an_error():
    for master, ok in (("spark://host:7077", False), ("yarn", False), ("local-cluster[2,1,1024]", False)):
        context = SimpleNamespace(getCheckpointDir=lambda: None, master=master)
        fake = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d=None: d))
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            config.checkpoint_dir(fake)


def test_least_accurate_intents_by_full_values(spark):
    rows = [("A", 999_999_998, 10**9), ("B", 999_999_997, 10**9), ("C", 10**9, 10**9)]
    per = spark.createDataFrame([(i, c, n, c / n * 100.0) for i, c, n in rows], "intent_true string, correct long, total long, accuracy double")
    assert [r.intent_true for r in evaluate.bottom_intent_accuracy(per, 2).collect()] == ["B", "A"]


def test_percentages_keep_all_digits(spark):
    rows = [(i, "train" if i else "val") for i in range(3)]
    got = {r.split: r.pct for r in splits.split_sizes(spark.createDataFrame(rows, "row_id long, split string")).collect()}
    assert got == {"train": 200 / 3, "val": 100 / 3}


def described(spark, values):
    return profile.numeric_describe(spark.createDataFrame([(v,) for v in values], "x double")).first()


def test_quantiles_of_infinite_and_huge_values(spark):
    inf = float("inf")
    d = described(spark, [1.0, 2.0, inf])
    assert (d.p25, d.p50, d.p75, d.max) == (1.5, 2.0, inf, inf)
    d = described(spark, [-inf, -inf, 0.0, 5.0, inf])
    assert (d.min, d.p25, d.p50, d.p75) == (-inf, -inf, 0.0, 5.0)
    d = described(spark, [-1.7e308, -1e308, 1e308, 1.7e308])
    assert (d.p25, d.p50, d.p75) == (-1.175e308, 0.0, 1.175e308)
    assert described(spark, [5e-324, 1e-323, 1.5e-323]).p50 == 1e-323


@pytest.mark.parametrize("small", [0, 100_000])
def test_quantiles_equal_sorting(spark, monkeypatch, small):
    import random

    rng = random.Random(small)
    values = [rng.choice((rng.gauss(0, 1), rng.randrange(9) * 1.0, rng.paretovariate(0.1))) for _ in range(4001)]
    long = spark.createDataFrame([("x", v) for v in values], "column_name string, value double")
    ranks, bounds = [0, 1000, 2000, 4000], {"x": (min(values), max(values))}
    # Brackets on the wrong side cost a scan, not exactness.
    for bracket in ((min(values), max(values)), (0.5, 0.6)):
        got = profile.order_statistics(long, [("x", k) for k in ranks], {("x", k): bracket for k in ranks}, bounds, buckets=16, small=small)
        assert [got["x", k] for k in ranks] == [sorted(values)[k] for k in ranks]


def test_missing_times_do_not_count(spark):
    times = spark.createDataFrame([(1.0,), (None,), (3.0,), (float("nan"),), (2.0,), (None,)], "inference_time_ms double")
    r = latency.latency_benchmark(times).first()
    assert (r.n, r.median_ms, r.mean_ms) == (3, 2.0, 2.0)
    none = latency.latency_benchmark(times.where("inference_time_ms > 9 and not isnan(inference_time_ms)")).first()
    assert (none.n, none.median_ms) == (0, None)


def test_tables_without_text_and_names_with_dots(spark):
    numbers = spark.createDataFrame([(1, 2.0), (2, None)], "`a.b` int, `c``d` double")
    assert profile.text_column_profile(numbers).collect() == [] and profile.text_samples(numbers, "a.b").collect() == []
    assert [tuple(r) for r in profile.null_counts(numbers).collect()] == [("c`d", 1)]
    assert {tuple(r) for r in profile.distinct_counts(numbers).collect()} == {("a.b", 2), ("c`d", 1)}
    assert {r.column_name: r.p50 for r in profile.numeric_describe(numbers).collect()} == {"a.b": 1.5, "c`d": 2.0}
    text = spark.createDataFrame([(1, "x" * 40), (2, "x" * 40), (3, "y" * 40)], "row_id int, `t.u` string")
    assert [(r.column_name, r.n_distinct, r.value[0], r.n) for r in profile.categorical_profile(text).collect()] == [("t.u", 2, "x", 2), ("t.u", 2, "y", 1)]
    assert {tuple(r) for r in profile.distinct_counts(text).collect()} == {("row_id", 3), ("t.u", 2)}
    assert [r.preview for r in profile.text_samples(text, "row_id", 1, 3).collect()] == ["xxx"]
    assert [tuple(r) for r in profile.value_counts(text, "t.u").orderBy("n").collect()] == [("y" * 40, 1), ("x" * 40, 2)]
    assert profile.numeric_describe(text.select("`t.u`")).collect() == []


def test_columns_of_many_values_are_not_shuffled(spark):
    df = spark.range(5000).selectExpr("cast(id as string) as many", "cast(id % 3 as string) as few")
    profiled = profile.categorical_profile(df)
    assert {r.column_name for r in profiled.collect()} == {"few"}
    plan = profiled._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning(column_name" in line and "value" in line]
    assert shuffled and "LeftSemi" in plan[plan.index(shuffled[0]) :]


def test_whole_numbers_keep_all_digits_in_ranges(spark):
    params = ['{"n":9007199254740993,"f":2.5,"b":true,"m":1}', '{"n":9007199254740992,"f":1e3,"b":false,"m":1.0}', '{"n":-12345678901234567890123456789,"f":null}']
    rows = [(i, "t", "A", f'[{{"id":"A","params":{p}}}]', 1) for i, p in enumerate(params)]
    utt = spark.createDataFrame(rows, "row_id long, transcript string, intent string, nli_output string, frequency long")
    got = {r.param: r for r in schema_mining.param_numeric_range(schema_mining.param_entries(schema_mining.annotated_rows(utt))).collect()}
    assert (int(got["n"].min_whole), int(got["n"].max_whole), got["n"].shown_values) == (-12345678901234567890123456789, 9007199254740993, 3)
    assert (got["f"].min_value, got["f"].min_whole, got["f"].max_whole, got["f"].shown_values) == (2.5, None, 1000, 2)
    assert (got["b"].min_whole, got["b"].max_whole, got["m"].shown_values) == (0, 1, 1)
