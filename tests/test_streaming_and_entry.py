"""Driver contract, the stateless stream, and plan shape checks."""

import tempfile

from conftest import SMALL

import __spark_entry__ as entry
from parlance.operators.annotations import preprocess
from parlance.sources import views
from parlance.operators.outputs import map_as_text, parse_outputs, response_record
from parlance.streaming import stream_responses, stream_training_pairs


def test_entry_and_registry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 90


def test_stream_equals_batch(spark):
    src = tempfile.mkdtemp(prefix="parlance-stream-src-")
    utt = views.utterances(spark, SMALL)
    utt.repartition(3).write.mode("overwrite").parquet(src)
    q = stream_training_pairs(spark, src).writeStream.format("memory").queryName("pairs_stream").start()
    q.processAllAvailable()
    q.stop()
    got = spark.sql("SELECT * FROM pairs_stream")
    want = preprocess(utt)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_streamed_repair_equals_batch(spark):
    src = tempfile.mkdtemp(prefix="parlance-stream-out-")
    raw = views.corrupted_outputs(spark, SMALL).unionByName(views.predictions(spark, SMALL).withColumnRenamed("pred_text", "raw"))
    raw.repartition(3).write.mode("overwrite").parquet(src)
    shown = lambda d: d.select("row_id", "settled_by", "resp_intent", map_as_text(d.resp_params).alias("p"), "resp_raw_output", "resp_error")
    q = shown(stream_responses(spark, src)).writeStream.format("memory").queryName("responses").start()
    q.processAllAvailable()
    q.stop()
    got, want = spark.sql("SELECT * FROM responses"), shown(response_record(parse_outputs(raw, "raw", "single")))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert {r.settled_by for r in got.select("settled_by").distinct().collect()} == {"strict", "scan", "regex", "sentinel"}


def test_flagship_plan_is_narrow(spark):
    plan = entry.entry(spark)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
