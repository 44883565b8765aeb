import numpy as np
import pytest
from conftest import SMALL
from llm.cases import AWKWARD, docs

import corpus_pipeline
from parlance.llm import mixing, queries
from parlance.llm.common import table


def shares(sizes, weights=(5, 2, 1), epochs=3):
    """Targets by resharing the excess, round by round; sizes by source in order."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    target, stopped, left = [0.0] * len(sizes), set(), float(sum(sizes))
    while left > 1e-9:
        free = [i for i in range(len(sizes)) if i not in stopped]
        total = sum(w[i] for i in free)
        for i in free:
            target[i] += left * w[i] / total
        left = 0.0
        for i in free:
            if target[i] >= epochs * sizes[i]:
                left += target[i] - epochs * sizes[i]
                target[i] = epochs * sizes[i]
                stopped.add(i)
    return target


@pytest.mark.parametrize("sizes", [[10, 1000, 5, 300, 40, 0], [1, 1, 1], [7], [0, 0], [5, 400, 3, 2, 1, 900, 1]])
def test_targets_equal_resharing(spark, sizes):
    rows = [(None if i == len(sizes) - 1 else f"s{i}", s) for i, s in enumerate(sizes)]
    got = mixing.targets(spark.createDataFrame(rows, "source string, size long")).orderBy("no").collect()
    assert [r.source for r in got] == [r[0] for r in rows]
    assert [r.target for r in got] == pytest.approx(shares(sizes))


def corpus():
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(f"t{x}" for x in rng.integers(0, 999, int(rng.integers(0, 300)))), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(400)]
    return rows + [(1000, " ".join(["long"] * 20_000), "a"), (1001, "tiny", "z"), (1002, "of few", "z")]


def test_taken_words_meet_the_targets(spark):
    d = docs(spark, corpus())
    got = mixing.Mixture(d).taken().collect()
    assert sorted(map(str, got)) == sorted(map(str, mixing.Mixture(d.repartition(7)).taken().collect()))
    assert len(got) == len(corpus()) and all(r.taken <= 3 * r.size for r in got)
    per = {}
    for r in got:
        x = per.setdefault((r.source_size, r.target), [0, 0])
        x[0] += r.taken
        x[1] += r.size
    for (size, target), (taken, total) in per.items():
        assert total == size and abs(taken - target) <= max(1, 0.03 * target)
    assert sum(t for _, t in per) == pytest.approx(sum(r.size for r in got))


@pytest.mark.parametrize("sizes", [[5, 100, 30], [1, 1, 1], [200, 3, 50, 1, 120], [150, 150, 2, 1, 60, 199]])
def test_small_sources_meet_their_targets_in_words(spark, sizes):
    rows = [(10 * i + j, " ".join(f"w{k}" for k in range(part)), f"s{i}") for i, n in enumerate(sizes) for j, part in enumerate((n // 3, n - n // 3)) if part]
    per = {}
    for r in mixing.Mixture(docs(spark, rows)).taken().collect():
        x = per.setdefault(r.doc_id // 10, [0, r.target])
        x[0] += r.taken
        assert r.taken <= 3 * r.size
    assert [x[1] for _, x in sorted(per.items())] == pytest.approx(shares(sizes))
    assert all(abs(taken - target) <= max(1, 0.03 * target) for taken, target in per.values())


def test_rows_of_no_id_spread_over_the_buckets(spark):
    rows = [(None, f"text {i} of {i % 7} words", "a") for i in range(400)] + [(1, "one text", "b")]
    m = mixing.Mixture(docs(spark, rows))
    placed = mixing._placed(m.sized.withColumnRenamed("size", "mix_size"), m.sources, m.buckets).collect()
    ats = sorted(r.mix_at for r in placed if r.doc_id is None)
    assert ats == [5 * i for i in range(400)]
    bucket = mixing.F.pmod(mixing.F.xxhash64("doc_id", "size", "mix_digest", mixing.F.lit(mixing.SEED)), mixing.F.lit(m.buckets))
    assert max(r["count"] for r in m.sized.groupBy(bucket.alias("b")).count().collect()) < 60
    taken = {r.doc_id: r.taken for r in m.taken().collect()}
    assert len(m.taken().collect()) == 401 and taken[1] in (1, 2, 3, 4, 5, 6)


def test_uses_equal_the_slots_one_by_one(spark):
    """The uses of every block against a walk over all slots; each epoch takes a block at most once."""
    m = mixing.Mixture(docs(spark, corpus()))
    slots = [tuple(r) for r in m.slots.collect()]
    assert len({(no, block, epoch) for _, no, block, epoch in slots}) == len(slots)
    count = {}
    for _, no, block, epoch in slots:
        assert 0 <= epoch < 3
        count[no, block] = count.get((no, block), 0) + 1
    assert {(r.no, r.block): r.uses for r in m.uses.collect()} == count
    for r in m.sources.collect():
        blocks = -(-r.source_size // r.block_words)
        assert sum(n for (no, _), n in count.items() if no == r.no) == round(r.target / max(r.source_size, 1) * blocks)


def test_permutations():
    for n in (1, 2, 3, 64, 1000):
        for key in (0, 5, 1 << 50):
            got = mixing.permute(np.arange(n), np.full(n, n), np.full(n, key))
            assert sorted(got.tolist()) == list(range(n))


def test_mixed_documents_hold_the_words_taken(spark):
    d = docs(spark, corpus())
    taken = {r.doc_id: r.taken for r in mixing.Mixture(d).taken().collect()}
    out = mixing.mixed_documents(d)
    assert out.columns == d.columns
    words = {}
    for r in out.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
        assert r.n_chars == len(r.text) and r.label == "x" and r.mix_no == 3
    assert words == {i: n for i, n in taken.items() if n}


def test_awkward_rows(spark):
    d = docs(spark, AWKWARD)
    got = mixing.Mixture(d).taken().collect()
    assert len(got) == len(AWKWARD)
    assert {(r.size, r.taken) for r in got if r.doc_id in (3, 4, 5)} == {(0, 0)}
    assert mixing.mixed_documents(d).columns == d.columns
    assert mixing.Mixture(docs(spark, [])).taken().count() == 0
    assert mixing.mixed_documents(docs(spark, [])).count() == 0
    assert [r.taken for r in mixing.Mixture(docs(spark, [(1, None, None)])).taken().collect()] == [0]


def test_pipeline_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "minhash_near_dedup", "decontamination", "source_mixing", "token_packing"]
    source = table(spark, SMALL, "documents")
    columns = source.columns
    dirty = source.unionByName(source.limit(3)).unionByName(
        spark.createDataFrame([(None, None, None, None, None), (10**6, "", None, None, 0)], source.schema)
    )
    d = dirty
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = d
        d = stage(spark, d, SMALL)
        assert d.columns == columns
        assert 0 < d.count()
        assert d.select("doc_id").distinct().count() <= before.select("doc_id").distinct().count()
    packed = corpus_pipeline.STAGES[-1][1](spark, d, SMALL)
    assert {x for r in packed.collect() for x in r.segment_docs} == {r.doc_id for r in d.collect()}


def test_pipeline_of_an_empty_table(spark):
    d = table(spark, SMALL, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        d = stage(spark, d, SMALL)
        assert d.count() == 0


def test_all_are_registered():
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 14))
