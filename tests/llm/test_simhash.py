import random

import numpy as np
from llm.cases import AWKWARD, docs
from pyspark.sql import functions as F

from parlance.llm import simhash


def least_reachable(prints):
    """Per (doc_id, fingerprint) row the least id reachable over pairs within 3 bits, by comparing all pairs."""
    label = list(range(len(prints)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, (_, p) in enumerate(prints):
        for j in range(i):
            if (p ^ prints[j][1]).bit_count() <= 3:
                label[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(prints):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, f"{p:016x}", least.get(find(i))) for i, (d, p) in enumerate(prints)]


def texts(seed):
    """Long texts with single changed words, so that fingerprints differ in few bits."""
    rng = random.Random(seed)
    rows = []
    for size in (60, 20, 5, 1, 1):
        base = [f"w{rng.randrange(500)}" for _ in range(600)]
        for _ in range(size):
            words = list(base)
            for _ in range(rng.randrange(6)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(words)))
    rng.shuffle(rows)
    return rows


def order(rows):
    return sorted(rows, key=str)


def test_fingerprints_and_groups_equal_brute_force(spark):
    rows = [*texts(1), (500, ""), (501, None), (502, "one"), (503, "ONE"), (504, "a b c d")]
    d = docs(spark, [(i, t, "a") for i, t in rows])
    got = [tuple(r) for r in simhash.near_duplicates(d).select("doc_id", "fingerprint", "component_id").collect()]
    # The same hashes from Spark's own function.
    word = F.split(F.trim(F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), r"\s+", " ")), " ")
    many = F.transform(F.sequence(F.lit(1), F.size("w") - 2), lambda i: F.xxhash64(F.array_join(F.slice("w", i, 3), " ")))
    hashed = d.select("doc_id", word.alias("w")).select("doc_id", "w", F.when(F.size("w") > 2, many).otherwise(F.array(F.xxhash64(F.array_join("w", " ")))).alias("h"))
    prints = []
    for r in hashed.collect():
        h = np.array(r.h, np.int64).view(np.uint64)
        ones = [(2 * int(((h >> np.uint64(j)) & np.uint64(1)).sum()) > len(h)) << j for j in range(64)]
        prints.append((r.doc_id, sum(ones) if r.w != [""] else 0))
    assert order(got) == order(least_reachable(prints))
    assert 3 < len({r[2] for r in got}) < len(rows) - 30


def test_links_of_a_ball_of_fingerprints(spark):
    rng = random.Random(4)
    near = {0} | {sum(1 << b for b in rng.sample(range(12), rng.randrange(5))) for _ in range(300)}
    far = {rng.getrandbits(64) for _ in range(200)}
    far |= {p ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for p in far}
    prints = sorted(near | far)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()
    want = {(a, b) for a, x in zip(signed, prints) for b, y in zip(signed, prints) if a < b and (x ^ y).bit_count() <= 3}
    assert {(r.a, r.b) for r in found} == want and len(found) == len(want)


def test_thresholds_cover_the_radius_and_avoid_crowds():
    rng = np.random.default_rng(2)
    crowd = rng.integers(0, 2**64, 2000, dtype=np.uint64)
    crowd[:1500] &= np.uint64(0xFFFFFFFF)  # half of the bits are the same in most
    for m in simhash.PARTITIONS:
        plan = simhash.Plan(crowd, 10**6, m)
        assert sorted(b for g in plan.groups for b in g) == list(range(64))
        units, cost = plan.allocate(crowd[:300])
        assert (units.sum(1) == simhash.RADIUS + 1).all() and np.isfinite(cost).all()
    low, high = (np.uint64(x) for x in (0xFFFFFFFF, 0xFFFFFFFF << 32))
    plan.groups, plan.masks = [list(range(32)), list(range(32, 64))], [low, high]
    units, _ = plan.allocate(crowd[:300])
    assert (units[:, 0] > units[:, 1]).all()


def test_awkward_rows_and_empty_table(spark):
    got = simhash.near_duplicates(docs(spark, AWKWARD)).collect()
    assert len(got) == len(AWKWARD)
    by = {r.doc_id: r for r in got}
    assert {by[i].component_id for i in (3, 4, 5)} == {3} and by[3].fingerprint == "0" * 16
    assert by[6].fingerprint == by[7].fingerprint and by[7].component_id == 6
    assert by[2].component_id == 1
    assert [r.component_id for r in simhash.near_duplicates(docs(spark, [(None, "a b", "x"), (None, "a b", "y")])).collect()] == [None, None]
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


def test_long_texts_are_counted_in_steps(monkeypatch):
    text = " ".join(f"w{i * i % 977}" for i in range(5000)).encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "STEP", 7)
    assert simhash.fingerprint(text) == whole
