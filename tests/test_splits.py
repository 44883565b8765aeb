"""Exact split sizes and split invariants."""

from pyspark.sql import functions as F

from parlance.operators.splits import split_quotas, stratified_split


def test_published_split_sizes(spark):
    # 35,516 rows over 72 intents must give 24,860 / 5,328 / 5,328.
    counts = [(f"I{i:02d}", 493 + (1 if i < 20 else 0)) for i in range(72)]
    assert sum(c for _, c in counts) == 35516
    df = spark.createDataFrame(counts, "intent string, c long")
    q = split_quotas(df).agg(F.sum("q_tv").alias("tv"), F.sum("q_train").alias("tr")).first()
    assert (q.tr, q.tv - q.tr, 35516 - q.tv) == (24860, 5328, 5328)


def test_split_invariants(spark):
    rows = []
    rid = 0
    for intent, n in (("A", 1000), ("B", 37), ("C", 3), ("D", 2), ("E", 250)):
        for _ in range(n):
            rows.append((rid, intent))
            rid += 1
    df = spark.createDataFrame(rows, "row_id long, intent string")
    s = stratified_split(df).cache()
    # rare intent D removed, every other row in exactly one split
    assert s.where("intent = 'D'").count() == 0
    assert s.count() == len(rows) - 2
    assert s.select("row_id").distinct().count() == s.count()
    sizes = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
    n = len(rows) - 2
    import math

    n_test = math.ceil(0.15 * n)
    n_val = math.ceil((0.15 / 0.85) * (n - n_test))
    assert sizes == {"test": n_test, "val": n_val, "train": n - n_test - n_val}
    # each intent's share within one row of proportional
    for r in s.groupBy("intent").pivot("split").count().collect():
        total = (r.train or 0) + (r.val or 0) + (r.test or 0)
        assert abs((r.test or 0) - total * n_test / n) < 1 + 1e-9 or total < 5
    # same membership after repartitioning the input
    again = stratified_split(df.repartition(7)).select("row_id", "split")
    assert again.exceptAll(s.select("row_id", "split")).count() == 0
