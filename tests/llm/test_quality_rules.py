import re
import zlib

import numpy as np
import pytest
from conftest import SMALL
from llm.cases import AWKWARD, docs

from parlance.llm import decontaminate, host_rules, mil_quality
from parlance.llm.common import table
from parlance.llm.text import blocks

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    w = WORD.findall(text or "")
    seen, covered = {}, set()
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i : i + 3]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            covered.update(i + j for i in at for j in range(3))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    n_symbols = sum(c in "#*$%&|<>" for c in text or "")
    return [len(w), sum(map(len, w)), n_symbols, len(lines) - len(set(lines)), len(covered)]


LINES = "one two three one two three\n#a | b\n#a | b\r\none two three four\n\n \n#a | b"


def test_measures_and_host_verdicts(spark):
    rows = [*AWKWARD, (20, LINES, "bad"), (21, "a b a b a b a b " * 20, "bad"), *((30 + i, f"short {i}", "bad") for i in range(40))]
    got = host_rules.judge(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    key = lambda x: tuple(map(str, x))
    mine = sorted(((i, *measures(t)) for i, t, _ in rows), key=key)
    assert sorted(((r.doc_id, *(r[c] for c in host_rules.MEASURES)) for r in got), key=key) == mine
    hosts = {}
    for _, t, s in rows:
        m = measures(t)
        hosts.setdefault(s, []).append(m[0] < 50 or 100 * m[4] > 50 * m[0])
    rate = [np.mean(v) for v in hosts.values()]
    m, v = np.mean(rate), np.var(rate)
    strength = max(m * (1 - m) / v - 1, 0)
    for r in got:
        f = hosts[r.host]
        assert (r.host_docs, r.host_failures) == (len(f), sum(f))
        assert r.host_rate == pytest.approx((sum(f) + m * strength) / (len(f) + strength))
        assert r.kept == (not r.base_failed and r.host_rate <= 0.5)
    assert host_rules.judge(docs(spark, [])).count() == 0


def test_classifier_on_held_out_documents(spark):
    docs_, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    model = mil_quality.train(docs_, labels)
    got = {r.doc_id: r.score for r in mil_quality.scores(docs_, model).collect()}
    marked = [(r.doc_id, r.quality) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    right = [(got[i] >= mil_quality.THRESHOLD) == (q == 1) for i, q in marked]
    assert len(right) > 10 and np.mean(right) >= 0.9
    again = mil_quality.train(docs_.repartition(5), labels.repartition(3))
    assert all(np.array_equal(model.p[k], again.p[k]) for k in model.p)


def test_sample_is_drawn_from_the_documents_at_hand(spark):
    """Labels of many other documents leave the sample of those at hand whole, in numbers and in shares."""
    texts = [(i, ("good plain words " if i % 2 else "### $$$ !!! ") * 40, "a") for i in range(200)] + [(1000, " ", "a")]
    labels = spark.createDataFrame([(i, int(i % 2) if i < 200 else int(i % 9 == 0)) for i in range(20_000)], "doc_id long, quality int")
    d = docs(spark, texts)
    model = mil_quality.train(d, labels, sample=100)
    assert model.constant is None
    got = {r.doc_id: r.score for r in mil_quality.scores(d, model).collect()}
    assert all((got[i] > 0.5) == bool(i % 2) for i in range(200))
    assert mil_quality.train(d.where("doc_id % 2 = 1"), labels).constant == 1.0


def test_encoder_sees_words(spark):
    """Two classes alike in every character class differ by their words alone."""
    rng = np.random.default_rng(9)
    words = {0: ["lorem", "ipsum", "dolor", "amets"], 1: ["mater", "pulse", "riven", "stone"]}
    rows = [(i, " ".join(rng.choice(words[i % 2], 150)), "a") for i in range(160)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(160)], "doc_id long, quality int")
    d = docs(spark, rows)
    model = mil_quality.train(d, labels)
    got = {r.doc_id: r.score for r in mil_quality.scores(d, model).collect()}
    assert np.mean([(got[i] > 0.5) == bool(i % 2) for i in range(160)]) > 0.98


def test_classifier_takes_awkward_rows(spark):
    d = docs(spark, AWKWARD)
    labels = spark.createDataFrame([(1, 1), (9, 0), (9, None), (10, 5), (None, 1), (8, 0), (8, 1)], "doc_id long, quality int")
    model = mil_quality.train(d, labels)
    got = mil_quality.scores(d, model).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in got if r.doc_id in (3, 4, 5)} == {mil_quality.EMPTY_SCORE}
    none = mil_quality.train(d, labels.where("false"))
    assert {r.score for r in mil_quality.scores(d, none).collect()} == {0.0, 0.5}
    kept = mil_quality.accepted(d, none, 0.4)
    assert kept.columns == d.columns and kept.count() == len(AWKWARD) - 3
    assert mil_quality.scores(docs(spark, []), none).count() == 0
    assert mil_quality.train(docs(spark, []), labels).constant is not None


def test_gradient_of_the_network(monkeypatch):
    """A step along the gradient must lower the loss as the gradient says."""
    monkeypatch.setattr(mil_quality, "STEPS", 60)
    rng = np.random.default_rng(2)
    at = np.concatenate([[0], np.cumsum(rng.integers(1, 6, 200))])
    x = rng.normal(size=(at[-1], 4))
    y = np.array([x[a:b, 0].max() > 1.0 for a, b in zip(at, at[1:])], float)  # one passage decides
    model = mil_quality.Model().fit(x, at, y)
    assert np.mean((model.score(x, at) > 0.5) == y) > 0.9


def test_passages_see_the_whole_text():
    import pyarrow as pa

    text = "plain words here " * 100 + "SHOUT!! " * 64 + "plain words again " * 50
    block = next(blocks(pa.array([None, text, ""]), False))
    x, at = mil_quality.passages(block)
    assert at.tolist() == [0, 0, 9, 9] == [0, 0, -(-514 // 64), -(-514 // 64)]
    assert x[4:7, 1].max() > 0.3 and x[0, 1] == 0 and x[-1, 1] == 0


def contained(rows, items, k=5):
    low = lambda t: [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(t or "")]
    out = []
    for item, q in items:
        w = low(q)
        m = min(k, len(w))
        s = {tuple(w[i : i + m]) for i in range(len(w) - m + 1)} if m else set()
        for i, t, _ in rows:
            d = low(t)
            n = len(s & {tuple(d[j : j + m]) for j in range(len(d) - m + 1)})
            if s and 100 * n >= 80 * len(s):
                out.append((i, item, len(s), n))
    return sorted(out, key=str)


def test_contained_items_equal_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(4)
    word = lambda n: " ".join(f"q{x}" for x in rng.integers(0, 3000, n))
    items = [(i, word(int(n))) for i, n in enumerate(rng.integers(6, 60, 30))]
    items += [(50, "Two Words"), (51, "single"), (52, None), (53, ""), (None, "three odd words")]
    rows = list(AWKWARD)
    for n in range(60):
        parts = [word(int(rng.integers(0, 400)))]
        for j in rng.integers(0, 30, int(rng.integers(0, 3))):
            w = items[j][1].upper().split()
            if n % 3 == 0:
                w[len(w) // 2] = "changed"
            parts += ["\n\t".join(w), word(int(rng.integers(0, 9000 if n < 4 else 60)))]
        rows.append((100 + n, " ".join(parts), "a"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = contained(rows, items)
    assert len(expected) > 30
    d = docs(spark, rows)
    for size in (decontaminate.BLOCK_SHINGLES, 100):
        monkeypatch.setattr(decontaminate.item_blocks, "__defaults__", (5, size))
        got = [tuple(r) for r in decontaminate.contained_items(d, bench).collect()]
        assert sorted(got, key=str) == expected
    clean = decontaminate.without_items(d, bench)
    hit = {x[0] for x in expected if x[0] is not None}
    assert clean.columns == d.columns
    assert {r.doc_id for r in clean.collect()} - {None} == {r[0] for r in rows} - hit - {None}


def test_decontamination_of_empty_tables(spark):
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.contained_items(docs(spark, []), bench).count() == 0
    assert decontaminate.contained_items(docs(spark, AWKWARD), bench.where("false")).count() == 0
    assert decontaminate.without_items(docs(spark, AWKWARD), bench.where("false")).count() == len(AWKWARD)


def test_items_of_few_shingles_are_all_found(spark):
    """The fewer shingles an item has, the less one may be lost: items of 1 to 20 words in documents of any length."""
    rng = np.random.default_rng(9)
    items = [(i, " ".join(f"i{i}w{x}" for x in range(1 + i % 20))) for i in range(600)]
    rows = []
    for n in range(200):
        parts = [t for i in range(n, 600, 200) for t in (items[i][1], " ".join(f"q{x}" for x in rng.integers(0, 3000, 1 << n % 12)))]
        rows.append((n, " ".join(parts), "a"))
    sizes = [max(1, i % 20 - 3) for i in range(600)]  # words that nothing else has: each item is in its one document, whole
    expected = sorted(((i % 200, i, n, n) for i, n in enumerate(sizes)), key=str)
    got = decontaminate.contained_items(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == expected


def test_training_reads_each_document_once(spark):
    """One labelled doc_id on a great many rows reaches the driver once."""
    good, bad = "plain words in a line " * 30, "BUY!!! | $$$ " * 30
    rows = [*((1, good, "a") for _ in range(50)), *((2, bad, "a") for _ in range(3)), (1, good + "more", "a")]
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    once = mil_quality.train(docs(spark, [rows[0], rows[50]]), labels)
    model = mil_quality.train(docs(spark, rows), labels)
    assert all(np.array_equal(once.p[k], model.p[k]) for k in once.p)


def test_repeated_items_give_every_pair(spark, monkeypatch):
    """Items equal as they stand, up to case or space, or in their shingle set, and null ids, as the SQL has them."""
    import duckdb

    from parlance.llm.sql import ORACLES

    long, loop = " ".join(f"k{i}" for i in range(40)), "a b c d e f"
    items = [(3, long), (5, long), (9, long.upper().replace(" ", "\n ")), (None, long), (4, "Two words"), (2, "two  WORDS"), (None, "lonely item")]
    items += [(20, loop + " a b c d e f a b c d e"), (21, loop + " a b c d e f a b c d e f"), (22, loop)]
    rows = [(1, "x " + long + " y", "a"), (1, "x " + long + " y", "a"), (None, long, "a"), (2, "two words", "b"), (3, "a lonely item", "b"), (4, (loop + " ") * 4, None), (5, None, "a")]
    con = duckdb.connect()
    for name, schema, values in (("documents", "doc_id BIGINT, text VARCHAR", [r[:2] for r in rows]), ("benchmark", "item_id BIGINT, text VARCHAR", items)):
        con.execute(f"CREATE TABLE {name} ({schema})")
        con.executemany(f"INSERT INTO {name} VALUES (?, ?)", values)
    expected = sorted(con.execute(ORACLES["op7_decontamination"]).fetchall(), key=str)
    assert {x[1] for x in expected} == {2, 3, 4, 5, 9, 20, 21, 22} and len(expected) == 14
    bench = spark.createDataFrame(items, "item_id long, text string")
    for ids, size, out in ((decontaminate.IDS, decontaminate.BLOCK_SHINGLES, decontaminate.OUT_ROWS), (1, 10, 1)):
        monkeypatch.setattr(decontaminate, "IDS", ids)
        monkeypatch.setattr(decontaminate, "OUT_ROWS", out)
        monkeypatch.setattr(decontaminate.item_blocks, "__defaults__", (5, size))
        got = [tuple(r) for r in decontaminate.contained_items(docs(spark, rows), bench).collect()]
        assert sorted(got, key=str) == expected
    assert {r.doc_id for r in decontaminate.without_items(docs(spark, rows), bench).collect()} == {5}
