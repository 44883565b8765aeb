"""Evaluation invariants, latency golden values, training-log rules."""

from pyspark.sql import functions as F

from conftest import SMALL
from parlance.operators import evaluate as ev
from parlance.operators import latency as lat
from parlance.operators import training_log as tl


def _aligned(spark, pairs):
    df = spark.createDataFrame([(i, p, r) for i, (p, r) in enumerate(pairs)], "row_id long, pred_text string, ref_text string")
    return ev.align_predictions(df.select("row_id", "pred_text"), df.select("row_id", "ref_text"))


def test_identity_scores_full(spark):
    texts = ['{"intent":"A","params":{"k":5,"t":{"u":"min"}}}', '{"intent":"B","params":{}}']
    r = ev.evaluation_report(_aligned(spark, [(t, t) for t in texts])).first()
    assert (r.exact_match, r.intent_accuracy, r.parse_success_rate) == (100.0, 100.0, 100.0)
    assert (r.param_precision, r.param_recall, r.param_f1) == (100.0, 100.0, 100.0)


def test_python_equality_and_symmetry(spark):
    pairs = [
        ('{"intent":"A","params":{"k":5.0,"b":true,"s":"5"}}', '{"intent":"A","params":{"k":5,"b":1,"s":5,"x":null}}'),
        ("not json", '{"intent":"A","params":{"k":1}}'),
        ('{"intent":"A","params":null}', '{"intent":"A","params":{"k":1}}'),
    ]
    c = ev.param_counts(_aligned(spark, pairs)).first()
    # k and b match (5 == 5.0, True == 1), "5" != 5; only the first pair counts
    assert (c.correct, c.predicted, c.reference) == (2, 3, 4)
    swapped = ev.param_counts(_aligned(spark, [(r, p) for p, r in pairs[:1]])).first()
    assert (swapped.predicted, swapped.reference) == (4, 3)
    a = _aligned(spark, pairs).collect()
    assert a[1].intent_pred == "PARSE_ERROR" and a[1].intent_true == "A"


def test_latency_golden(spark):
    times = [651, 527, 445, 493, 389, 745, 341, 514, 338, 279]
    df = spark.createDataFrame([(float(t),) for t in times], "inference_time_ms double")
    r = lat.latency_benchmark(df).first()
    assert (round(r.mean_ms, 1), r.median_ms, r.min_ms, r.max_ms) == (472.2, 493.0, 279.0, 745.0)


def test_running_best(spark):
    hist = spark.createDataFrame([(1, 0.9, 0.5), (2, 0.5, 0.6), (3, 0.4, 0.4), (4, 0.395, 0.4)], "epoch int, train_loss double, val_loss double")
    got = [(r.epoch, r.is_best) for r in tl.running_best_loss(hist).orderBy("epoch").collect()]
    assert got == [(1, True), (2, False), (3, True), (4, False)]
    d = tl.loss_delta(hist).first()
    assert d.status == "plateau" and d.n_epochs == 4
    flat = tl.history_rows(tl.history_document(hist)).orderBy("epoch").collect()
    assert [r.val_loss for r in flat] == [0.5, 0.6, 0.4, 0.4]


def test_stored_outputs_and_references_join_without_an_exchange(spark):
    from parlance.plans import q_evaluate
    from parlance.sources import views

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = q_evaluate._aligned(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    pairs = views.pairs(spark, SMALL)
    assert views.references(spark, SMALL).count() == views.predictions(spark, SMALL).count() == pairs.count()


def test_bucketed_tables_keep_every_row(spark, tmp_path):
    from parlance.sources.tables import write_bucketed

    df = spark.createDataFrame([(None, "a"), (None, "b"), (1, "c"), (1, "c")], "row_id long, t string")
    for i, rows in enumerate((df, df.limit(0))):
        table = spark.table(write_bucketed(rows, str(tmp_path / str(i)), "row_id", 3))
        assert sorted(map(str, table.collect())) == sorted(map(str, rows.collect())) and table.columns == rows.columns


def test_metrics_of_both_sets_come_from_one_pass_without_an_exchange(spark, monkeypatch):
    from parlance.plans import q_sinks

    read, with_counts = [], ev._with_counts
    monkeypatch.setattr(ev, "_with_counts", lambda aligned: read.append(aligned) or with_counts(aligned))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = q_sinks.q_sink_metrics(spark, SMALL).collect()
        assert len(read) == 1 and sorted(d.eval_set for d in docs) == ["test", "val"]
        assert "Exchange" not in read[0]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_tally_gives_every_set_its_metrics(spark):
    good, other = '{"intent":"A","params":{"k":1,"s":"x"}}', '{"intent":"B","params":{"k":1.0}}'
    pairs = [(1, "val", good, good), (1, "val", good, good), (2, "val", "no", good), (3, "test", other, good), (4, "test", None, other), (5, "test", good, "[1]")]
    rows = spark.createDataFrame(pairs, "row_id long, split string, pred_text string, ref_text string")
    aligned = rows.withColumns({"intent_pred": ev.extract_pred_intent("pred_text"), "intent_true": ev.extract_ref_intent("ref_text")})
    tally = ev.evaluation_tally(aligned, "split")
    for s in ("val", "test", "none"):
        own, told = aligned.where(f"split = '{s}'"), tally.where(f"split = '{s}'")
        want = own.agg(ev.exact_match(), ev.intent_accuracy(), ev.parse_success_rate()).first().asDict()
        want |= {"total_samples": own.count()} | ev.param_prf(ev.param_counts(own)).drop(*ev.PAIR_COUNTS).first().asDict()
        assert ev.tallied_report(told).first().asDict() == want
        per = own.groupBy("intent_true").agg(F.expr("sum(int(intent_pred <=> intent_true))"), F.count("*"), ev.intent_accuracy()).collect()
        assert sorted(map(tuple, ev.tallied_accuracy(told).collect())) == sorted(map(tuple, per))
    assert ev.tallied_report(tally.where("split = 'val'")).first().param_precision == 100.0
