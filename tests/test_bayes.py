"""The counted classifier against a direct computation, and its rows at the edges."""

import math
import random
from collections import Counter

import pytest

from parlance.operators import bayes


def by_hand(train, text, alpha):
    """Scores by intent in nats, one term per known token."""
    counts = {}
    docs = Counter(i for i, _ in train if i is not None)
    for i, t in train:
        if i is not None:
            counts.setdefault(i, Counter()).update((t or "").lower().split())
    vocab = {w for c in counts.values() for w in c}
    out = {}
    for i, c in counts.items():
        total = sum(c.values())
        out[i] = math.log(docs[i] / sum(docs.values())) + sum(
            math.log((c[w] + alpha) / (total + alpha * len(vocab))) for w in (text or "").lower().split() if w in vocab
        )
    return out


def corpus(seed=4):
    rng = random.Random(seed)
    words = {"A": "on off lamp Light room", "B": "play song next Loud room", "C": "call mum now room"}
    train = [(i, " ".join(rng.choices(words[i].split() + ["the", "a"], k=rng.randrange(0, 9)))) for i in rng.choices("AABC", k=120)]
    return train + [(None, "left out entirely"), ("B", None), ("A", " \t\n")]


@pytest.mark.parametrize("alpha", [1.0, 0.1])
def test_scores_equal_direct_computation(spark, alpha):
    train = corpus()
    rows = [(n, t) for n, (_, t) in enumerate(corpus(5))] + [(900, "unseen words"), (901, None), (902, "LAMP lamp  Unseen lamp")]
    counts = bayes.train_counts(spark.createDataFrame(train, "intent string, text string"))
    df = spark.createDataFrame(rows, "row_id long, text string")
    got = {r.row_id: {s.intent: s.score / bayes.UNIT for s in r.scores} for r in bayes.scored(counts, df, alpha).collect()}
    assert got.keys() == {n for n, _ in rows}
    for n, t in rows:
        assert got[n] == pytest.approx(by_hand(train, t, alpha), abs=1e-6)
    said = {r.row_id: r for r in bayes.predict(counts, df.repartition(5), alpha).collect()}
    for n, scores in got.items():
        assert said[n].intent_pred == max(sorted(scores), key=scores.get)
        assert said[n].pred_text == f'{{"intent":"{said[n].intent_pred}","params":{{}}}}'
    true = [(n, i, t) for n, (i, t) in enumerate(corpus(6)) if i] + [(990, "not trained", "lamp")]
    loss = bayes.log_loss(counts, spark.createDataFrame(true, "row_id long, intent string, text string"), alpha).first()[0]
    direct = []
    for _, i, t in true[:-1]:
        s = by_hand(train, t, alpha)
        direct.append(math.log(sum(math.exp(x) for x in s.values())) - s[i])
    assert loss == pytest.approx(sum(direct) / len(direct), abs=1e-6)


def test_counts_of_parts_add_up(spark):
    train = spark.createDataFrame([(n, *r) for n, r in enumerate(corpus())], "n long, intent string, text string")
    whole = sorted(map(str, bayes.train_counts(train).collect()))
    parts = [bayes.train_counts(train.where(f"n % 3 = {k}")) for k in range(3)]
    assert sorted(map(str, bayes.merged(*parts).collect())) == whole


def test_best_of_the_grid_and_empty_tables(spark):
    train = spark.createDataFrame(corpus(), "intent string, text string")
    val = spark.createDataFrame([(n, *r) for n, r in enumerate(corpus(8))], "row_id long, intent string, text string")
    counts = bayes.train_counts(train)
    rows = bayes.select_best(counts, val).collect()
    assert [r.alpha for r in sorted(rows, key=lambda r: -r.alpha)] == list(bayes.GRID) and sum(r.is_best for r in rows) == 1
    assert min(rows, key=lambda r: r.val_log_loss).is_best
    nothing = bayes.train_counts(train.where("false"))
    assert nothing.count() == 0
    assert {r.intent_pred for r in bayes.predict(nothing, val).collect()} == {None}
    assert bayes.predict(counts, val.where("false")).count() == 0
