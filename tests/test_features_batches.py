"""Token rows that must not vanish, batches over sparse ids, the classifier's accuracy."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SMALL
from parlance.operators import classifier as clf
from parlance.operators import features as fe
from parlance.plans import q_features


def test_rows_without_tokens_stay(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, ""), (3, None), (4, "  \n"), (5, "zz " * 40)], "row_id long, text string")
    vocab = fe.build_vocabulary(fe.tokens(df, "text").where("row_id < 5"))
    ids = fe.encode_tokens(df, "text", vocab, keep=4)
    padded, mask = fe.pad_truncate_ids(F.col("ids"), 4)
    rows = ids.select("row_id", padded.alias("padded"), mask.alias("mask"), fe.mask_labels(padded).alias("labels"))
    got = {r.row_id: (r.padded, sum(r["mask"])) for r in rows.collect()}
    assert got == {1: ([3, 4, 3, 1], 4), 2: ([1, 0, 0, 0], 1), 3: ([1, 0, 0, 0], 1), 4: ([1, 0, 0, 0], 1), 5: ([2, 2, 2, 1], 4)}
    text = {r.row_id: r.text for r in fe.unmask_decode(rows, "labels", vocab).collect()}
    assert text == {1: "a b a", 2: "", 3: "", 4: "", 5: ""}


def test_cut_before_the_explode_changes_nothing(spark):
    df = spark.createDataFrame([(i, " ".join(f"t{j}" for j in range(i))) for i in range(12)], "row_id long, text string")
    vocab = fe.build_vocabulary(fe.tokens(df, "text"))
    for n in (1, 2, 5, 11, 12):
        whole, cut = (
            {r.row_id: r.p for r in e.select("row_id", fe.pad_truncate_ids(F.col("ids"), n)[0].alias("p")).collect()}
            for e in (fe.encode_tokens(df, "text", vocab, keep=k) for k in (None, n))
        )
        assert whole == cut and len(cut) == 12


def test_encoding_and_decoding_do_not_shuffle_rows(spark):
    words = [f"w{i}" for i in range(300)] + ["é", "王", "a.b"]
    rows = [(1, " ".join(words)), (1, "w1 new w2"), (None, "王 a.b"), (2, None)]
    df = spark.createDataFrame(rows, "row_id long, text string")
    vocab = fe.build_vocabulary(fe.tokens(df, "text").where("token <> 'new'"))
    ids = fe.encode_tokens(df, "text", vocab)
    back = fe.unmask_decode(ids, "ids", vocab)
    assert sorted(map(str, ((r.row_id, r.text) for r in back.collect()))) == sorted(
        map(str, [(1, " ".join(words)), (1, "w1 w2"), (None, "王 a.b"), (2, "")])
    )
    known = {r.token: r.id for r in vocab.collect()}
    want = [[known.get(t, fe.UNK_ID) for t in (text or "").split()] + [fe.EOS_ID] for _, text in rows]
    assert sorted(r.ids for r in ids.collect()) == sorted(want)
    plan = fe.encode_tokens(df, "text", vocab)._jdf.queryExecution().executedPlan().toString()
    assert "_table" not in plan  # the two projections are one
    main = [line for line in plan.splitlines() if line and not line.startswith("   :") and not line.startswith("      :")]
    assert not any("Exchange" in line or "Generate" in line for line in main)


@pytest.mark.parametrize("outlier", [1 << 62, -(1 << 62)])
def test_positions_with_an_outlying_id(spark, outlier):
    rows = [(i * 7, ("train", "val", "test")[i % 3]) for i in range(900)] + [(outlier, "val")]
    splits = spark.createDataFrame(rows, "row_id long, split string")
    got = {(r.row_id, r.position) for r in fe.assign_batches(splits).where("split <> 'train'").collect()}
    plain = splits.where("split <> 'train'").withColumn("p", F.row_number().over(Window.partitionBy("split").orderBy("row_id")))
    assert got == {(r.row_id, r.p) for r in plain.collect()}


def test_buckets_survive_sparse_ids(spark):
    from parlance.operators.positions import with_id_bucket

    df = spark.createDataFrame([(i,) for i in range(1000)] + [(1 << 62,)], "row_id long")
    sizes = [r["count"] for r in with_id_bucket(df, "b").groupBy("b").count().collect()]
    assert max(sizes) < 20


def test_classifier_beats_the_majority(spark):
    train, val, test = q_features._clf_data(spark, SMALL)
    model, candidates = clf.select_best_model(train.unionByName(val), val, grid=(0.0, 0.0, 0.1))
    marks = [r.is_best for r in candidates.orderBy("reg_param").collect()]
    assert sum(marks) == 1
    rows = clf.predict_intents(model, train).join(train.select("row_id", "intent"), "row_id").collect()
    majority = max(sum(r.intent == x for r in rows) for x in ("KEEP", "DROP"))
    assert sum(r.intent == r.intent_pred for r in rows) > majority
    assert test.count() > 0


def _few_texts(spark):
    """Train rows, and texts on which their model rates the class of unseen intents highest."""
    import random

    rnd = random.Random(2)
    texts = [" ".join(f"w{rnd.randrange(12)}" for _ in range(rnd.randrange(2, 9))) for _ in range(30)]
    train = spark.createDataFrame([(i, t, "AB"[i % 2]) for i, t in enumerate(texts)], "row_id long, text string, intent string").coalesce(1)
    test = spark.createDataFrame([(k, f"w{k} " * 200) for k in range(12)], "row_id long, text string")
    return train, test


def test_reloaded_model_agrees_on_texts_unlike_the_train_rows(spark, tmp_path):
    train, test = _few_texts(spark)
    model = clf.train_intent_classifier(train)
    assert 2.0 in {r.prediction for r in model.transform(test).collect()}
    again = clf.model_roundtrip(model, str(tmp_path / "model"))
    before, after = ({r.row_id: r.intent_pred for r in clf.predict_intents(m, test).collect()} for m in (model, again))
    assert before == after and len(before) == 12 and set(before.values()) == {"A", "B"}


def test_predicted_intent_is_the_likeliest_learnt_one(spark):
    from pyspark.ml.functions import vector_to_array

    train, test = _few_texts(spark)
    model = clf.train_intent_classifier(train)
    rows = model.transform(test).select("row_id", "prediction", vector_to_array("rawPrediction").alias("raw")).collect()
    assert model.stages[3].labels == ["A", "B"] and 2.0 in {r.prediction for r in rows}
    want = {r.row_id: "A" if r.raw[0] >= r.raw[1] else "B" for r in rows}
    got = clf.predict_intents(model, test).collect()
    assert {r.row_id: r.intent_pred for r in got} == want and len(got) == 12
    assert all(r.pred_text == f'{{"intent":"{r.intent_pred}","params":{{}}}}' for r in got)


def test_null_texts_are_learnt_and_predicted_as_empty_ones(spark):
    train, test = _few_texts(spark)
    gaps, blank = (train.withColumn("text", F.when(F.col("row_id") % 5 > 0, F.col("text")).otherwise(F.lit(x))) for x in (None, ""))
    asked = test.unionByName(spark.createDataFrame([(98, None), (99, "")], "row_id long, text string"))
    got, want = ({r.row_id: (r.intent_pred, r.pred_text) for r in clf.predict_intents(clf.train_intent_classifier(t), asked).collect()} for t in (gaps, blank))
    assert got == want and len(got) == 14 and got[98] == got[99]
    losses, same = ([r.val_log_loss for r in clf.select_best_model(t, t, grid=(0.1,))[1].collect()] for t in (gaps, blank))
    assert losses == pytest.approx(same) and 0 < losses[0] < 1


def test_queries_predict_rows_with_null_texts(spark, tmp_path):
    docs = [(i, None if i % 4 == 0 else f"good words {i}" if i % 3 else f"bad junk {i}") for i in range(80)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, min(i % 3, 1)) for i in range(80)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    train, _, test = (x.collect() for x in q_features._clf_data(spark, str(tmp_path)))
    assert any(r.text is None for r in train) and any(r.text is None for r in test)
    got = {r.row_id: r.intent_pred for r in q_features.q_predict_intents(spark, str(tmp_path)).collect()}
    assert got.keys() == {r.row_id for r in test} and all(got[r.row_id] == r.intent for r in test if r.text)
    assert len({got[r.row_id] for r in test if r.text is None}) == 1
    assert q_features.q_train_intent_classifier(spark, str(tmp_path)).count() == len(train)


def test_every_epoch_is_another_permutation(spark):
    from pyspark.sql import functions as F

    from parlance.operators import features

    for n in (0, 1, 2, 7, 1000):
        stored = spark.range(n).selectExpr("id * 3 as row_id", "'train' as split", "id + 1 as position")
        got = features.epoch_batches(stored.unionByName(stored.limit(5).withColumn("split", F.lit("val"))), 3)
        orders = {}
        for r in got.collect():
            orders.setdefault(r.epoch, {})[r.position] = r.row_id
            assert r.batch == (r.position - 1) // 16
        assert all(sorted(o) == list(range(1, n + 1)) and sorted(o.values()) == [3 * i for i in range(n)] for o in orders.values())
        assert len(orders) == (3 if n else 0)
        if n == 1000:
            shown = [[o[i] for i in range(1, n + 1)] for o in orders.values()]
            assert all(sum(a == b for a, b in zip(x, y)) < 20 for x, y in zip(shown, [*shown[1:], list(range(0, 3 * n, 3))]))
            # Neighbours do not stay neighbours.
            assert all(sum(abs(a - b) == 3 for a, b in zip(o, o[1:])) < 40 for o in shown)
    assert "Exchange hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()
