import random
import re
from collections import Counter

import numpy as np
import pytest
from llm.cases import AWKWARD, docs

from parlance.llm import collocations as co


def brute(rows, least, top):
    """The result by plain counting of all phrases of (lang, text)."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, words = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(low)):
            w = [x for x in re.split("[ \t]", piece) if x]
            words[lang] += len(w)
            for n in range(1, 5):
                for i in range(len(w) - n + 1):
                    counts.setdefault(lang, Counter())[tuple(w[i : i + n])] += 1
    out = []
    for lang, f in counts.items():
        good = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = lambda p, q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        kept = []
        for p, a in good.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and inside(p, q) for q, b in good.items()):
                continue
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, words[lang], -s))
    return sorted(out)


def corpus(seed, n):
    rng = random.Random(seed)
    vocab = [f"{rng.choice('abcé')}{i}" for i in range(30)]
    fixed = ["New York City hall", "et cetera", "a priori", "one two three", "x y z"]
    rows = []
    for _ in range(n):
        said = [rng.choice(fixed) if rng.random() < 0.2 else rng.choice(vocab) + rng.choice(["", "", ".", ",\t", "\x0b", "!?"]) for _ in range(rng.randrange(60))]
        rows.append((rng.choice(["en", "en", "fr", None, ""]), rng.choice([" ", "  ", " \t"]).join(said)))
    return rows


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "k", 1) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, phrase string, n int")


def found(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


@pytest.mark.parametrize(("least", "top", "mass"), [(30, 2000, 1 << 22), (4, 25, 3000)])
def test_equals_counting_everything(spark, monkeypatch, least, top, mass):
    # A small mass gives many hash partitions, whose summaries have to drop counters.
    monkeypatch.setattr(co, "MASS", mass)
    monkeypatch.setattr(co, "BUFFER", mass)
    monkeypatch.setattr(co, "PHRASES", max(50, mass >> 4))
    rows = corpus(3, 400)
    want = brute(rows, least, top)
    assert found(co.collocations(table(spark, rows).repartition(5), least, top)) == want
    assert len(want) >= 20


def test_a_full_filter_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(co, "FILTER", 8)
    rows = corpus(5, 100)
    assert found(co.collocations(table(spark, rows), 10, 100)) == brute(rows, 10, 100)


def test_merged_summaries_keep_frequent_keys():
    rng = np.random.default_rng(3)
    stream = np.concatenate([rng.zipf(1.3, 20000) % 100_000, rng.integers(0, 100_000, 20000)]).astype(np.uint32)
    rng.shuffle(stream)
    parts = [np.unique(x, return_counts=True) for x in np.array_split(stream, 9)]
    for least in (30, 200):
        keys, counts, error = co.merged(parts, len(stream) // least + 1)
        assert error < least and len(keys) <= len(stream) // least + 1
        exact = Counter(stream.tolist())
        kept = dict(zip(keys.tolist(), counts.tolist()))
        assert all(kept.get(k, 0) <= f <= kept.get(k, 0) + error for k, f in exact.items())
        assert all(k in kept for k, f in exact.items() if f >= least)


def test_products_beyond_64_bits(spark):
    big = 9 * 10**14
    rows = [("en", 1, "a", 2 * big), ("en", 1, "b", 3 * big + 1), ("en", 2, "a b", big * 2 - 1), ("en", 0, "", 10**18)]
    got = co.scored(spark.createDataFrame(rows, "lang string, n int, phrase string, f long")).collect()
    assert [r.score for r in got] == [2000000 * (2 * big - 1) // (5 * big + 1)]


def test_awkward_rows_and_empty_table(spark):
    d = docs(spark, AWKWARD)
    rows = [(r.lang, r.text) for r in d.collect()]
    assert found(co.collocations(d, 3, 50)) == brute(rows, 3, 50)
    assert co.collocations(docs(spark, [])).collect() == []
    assert co.collocations(docs(spark, [(1, None, "a"), (2, "", "a")])).collect() == []
