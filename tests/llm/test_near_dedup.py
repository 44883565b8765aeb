import random

import numpy as np
import pytest
from llm.cases import AWKWARD, PROSE, docs

from parlance.llm import graph, near_dedup
from parlance.llm.text import Block, blocks, row_sets

SPACE = " \t\n\x0b\x0c\r"


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in SPACE:
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w]


def shingles(text, k):
    w = words(text)
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def brute(rows, k):
    sets = {i: shingles(t, k) for i, t in rows}
    label = {i: i for i in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                label[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def families(seed):
    """Large families of copies with every degree of change, so that buckets are dense and mixed."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for size in (90, 60, 5, 2, 2, 1, 1):
        base = [rng.choice(vocab) for _ in range(120)]
        for _ in range(size):
            text = [rng.choice(vocab) if rng.random() < rng.choice((0, 0.02, 0.05, 0.08, 0.12)) else w for w in base]
            if rng.random() < 0.3:
                del text[rng.randrange(90) : rng.randrange(95, 105)]
            rows.append((n, " ".join(text)))
            n += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("k", [2, 5])
def test_groups_equal_brute_force(spark, k):
    rows = families(k)
    got = near_dedup.near_duplicates(docs(spark, [(i, t, "a") for i, t in rows]), k).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, k)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_any_reference_gives_the_same_links(spark, monkeypatch):
    rows = families(11)
    for typical in (1, 3):
        monkeypatch.setattr(near_dedup, "TYPICAL", typical)
        got = near_dedup.near_duplicates(docs(spark, [(i, t, "a") for i, t in rows]), 2).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, 2)


def template(n):
    """Texts of one template of which 4 to 13 % of the words are changed: few are linked."""
    rng = random.Random(5)
    base = [f"t{i}" for i in range(200)]
    rates = [rng.uniform(0.04, 0.13) for _ in range(n)]
    return [(i, " ".join(f"v{rng.randrange(10**6)}" if rng.random() < p else w for w in base)) for i, p in enumerate(rates)]


@pytest.mark.parametrize("n", [100, 400])
def test_template_texts_are_not_compared_in_all_pairs(spark, monkeypatch, n):
    met = []
    between = near_dedup._Search._between
    monkeypatch.setattr(near_dedup._Search, "_between", lambda self, m: met.append(between(self, m)) or met[-1])
    rows = template(n)
    got = near_dedup.near_duplicates(docs(spark, [(i, t, "a") for i, t in rows]), 2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, 2)
    assert met[0].count() < 0.02 * n * n / 2


def test_awkward_rows(spark):
    got = near_dedup.near_duplicates(docs(spark, AWKWARD), 2).collect()
    assert len(got) == len(AWKWARD)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert by[1] == [by[1][0]] * 2 and by[1][0][1:] == (1, True)
    assert by[2][0][1:] == (1, False)  # upper case is the same
    assert sorted(by[None], key=str)[0][2] is False or sorted(by[None], key=str)[1][2] is False
    assert {by[i][0] for i in (3, 4, 5)} == {(0, 3, True), (0, 4, True), (0, 5, True)}
    assert by[6][0] == (1, 6, True) and by[7][0] == (1, 6, False) and by[8][0] == (1, 8, True)
    assert by[10][0] == (60_000, 10, True) and by[11][0] == (1, 11, True)


def test_an_id_with_two_unlike_texts_does_not_join_their_groups(spark):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    got = near_dedup.near_duplicates(docs(spark, [(5, a, "a"), (5, b, "a"), (7, a, "a"), (8, b, "a"), (9, b + " c", "a")]), 2).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(5, 5), (5, 5), (7, 5), (8, 5), (9, 5)]


def test_stage_keeps_one_of_each_and_all_columns(spark):
    d = docs(spark, AWKWARD)
    out = near_dedup.one_of_each(d)
    assert out.columns == d.columns
    ids = sorted(r.doc_id for r in out.collect() if r.doc_id is not None)
    assert ids == [1, 3, 4, 5, 6, 8, 9, 10, 11]
    assert [r.text for r in out.where("doc_id is null").collect()] == ["other words here"]


def test_copies_without_id_go_and_odd_column_names_stay(spark):
    d = docs(spark, [(None, PROSE, "a")] * 5 + [(3, PROSE, "a"), (None, "one two", "b"), (None, "one two", "c")])
    d = d.select("*", d.doc_id.alias("key_doc_id"), d.text.alias("a.b"), d.lang.alias("row"), d.lang.alias("keys"))
    out = near_dedup.one_of_each(d)
    assert out.columns == d.columns
    assert sorted((str(r.doc_id), r.text) for r in out.collect()) == [("3", PROSE), ("None", "one two")]
    assert near_dedup.near_duplicates(d).count() == 8


def test_empty_table(spark):
    assert near_dedup.near_duplicates(docs(spark, [])).count() == 0


def test_registers_estimate_similarity():
    rng = np.random.default_rng(1)
    for share in (0.3, 0.8, 0.95):
        pool = np.unique(rng.integers(0, 2**64, 40_000, dtype=np.uint64))
        n = 10_000
        common = int(2 * n * share / (1 + share))
        a, b = pool[:n], pool[n - common : 2 * n - common]
        x, y = near_dedup.registers(np.sort(a)), near_dedup.registers(np.sort(b))
        either = ((x != near_dedup.EMPTY) | (y != near_dedup.EMPTY)).sum()
        assert abs(((x == y) & (x != near_dedup.EMPTY)).sum() / either - share) < 0.13


def test_word_hashes_do_not_depend_on_blocks(monkeypatch):
    import pyarrow as pa

    from parlance.llm import text

    rows = ["Ab c\x0bd", "", None, "é " * 50, " lead", "trail ", "word" * 40, "a b c"]
    whole = [s.tolist() for b in blocks(pa.array(rows), True) for _, s in row_sets(b, 2)]
    monkeypatch.setattr(text, "BLOCK", 16)
    parts = [s.tolist() for b in blocks(pa.array(rows), True) for _, s in row_sets(b, 2)]
    assert whole == parts
    assert [len(s) for s in whole] == [len(shingles(r, 2)) for r in rows]
    assert isinstance(next(blocks(pa.array(rows), True)), Block)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(100, 100 + i) for i in range(1, 50)] + [(149, 149)]
    got = graph.components(spark.createDataFrame(chain + star, "a long, b long")).collect()
    assert {r.node: r.label for r in got} == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 150)}


def test_texts_that_share_an_id_or_have_none(spark):
    rng = random.Random(3)
    text = lambda: " ".join(f"v{rng.randrange(10**6)}" for _ in range(100))
    a, b, c, d, e = (text() for _ in range(5))
    chain = [d, d + " " + " ".join(f"x{i}" for i in range(20)), d + " " + " ".join(f"x{i}" for i in range(40))]
    rows = [(5, a, "a"), (7, a, "b"), (7, b, "a"), (8, b, "a"), (7, c, "a"), (7, c, "z"), (7, c, "a"), (7, "", "a"), (7, None, "a")]
    rows += [(20, chain[0], "a"), (None, chain[1], "a"), (21, chain[2], "a"), (None, e, "a"), (None, e + " y", "a")]
    got = near_dedup.near_duplicates(docs(spark, rows), 2).collect()
    assert len(got) == len(rows)
    found = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in got)
    assert found == sorted(
        [("5", "5", True), ("7", "5", False), ("7", "7", True), ("8", "7", False), *[("7", "7", True)] * 5]
        + [("20", "20", True), ("None", "20", False), ("21", "20", False), *[("None", "None", True)] * 2]
    )
    kept = [
        sorted((r.doc_id, str(r.text), r.source) for r in near_dedup.one_of_each(docs(spark, rows).repartition(n), 2).collect() if r.doc_id is not None)
        for n in (1, 5)
    ]
    assert [x[:2] for x in kept[0]] == sorted([(5, a), (7, b), (7, c), (7, ""), (7, "None"), (20, chain[0])])
    assert kept[0] == kept[1]
