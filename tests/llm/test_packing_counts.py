import numpy as np
from llm.cases import AWKWARD, docs

from parlance.llm import packing, piece_counts


def test_best_fit_decreasing_equals_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(40):
        length = int(rng.integers(3, 70))
        sizes = rng.integers(1, length + 1, int(rng.integers(0, 200)))
        rows, room = [], []
        for i in np.argsort(-sizes, kind="stable"):
            fits = [(r, j) for j, r in enumerate(room) if r >= sizes[i] and r > 0]
            if fits and sizes[i] < length:
                least = min(r for r, _ in fits)
                room[next(j for r, j in fits if r == least)] -= sizes[i]
            else:
                room.append(length - sizes[i])
        rows = packing.best_fit_decreasing(sizes, length)
        assert sorted(i for r in rows for i in r) == list(range(len(sizes)))
        assert all(sizes[r].sum() <= length for r in rows)
        assert sorted(length - sizes[r].sum() for r in rows) == sorted(room)


def test_rows_hold_every_token(spark):
    import tiktoken

    ranks = packing.read_vocabulary(packing.VOCABULARY)
    enc = tiktoken.Encoding("t", pat_str=packing.PATTERN, mergeable_ranks=ranks, special_tokens={})
    end = max(ranks.values()) + 1
    rows = packing.pack(docs(spark, AWKWARD), length=128, shard_bytes=100_000).collect()
    whole = {}
    for r in rows:
        ids, pos = np.frombuffer(r.input_ids, "<u2"), np.frombuffer(r.position_ids, "<u2")
        assert len(ids) == len(pos) == 128 and r.cu_seqlens[-1] == r.n_tokens <= 128
        for doc, at, lo, hi in zip(r.segment_docs, r.segment_offsets, r.cu_seqlens, r.cu_seqlens[1:]):
            assert pos[lo:hi].tolist() == list(range(hi - lo))
            whole.setdefault(doc, []).append((at, ids[lo:hi].tolist()))
        assert set(ids[r.n_tokens :]) <= {end}
    texts = {}
    for i, t, _ in AWKWARD:
        if t:
            texts.setdefault(i, []).append(t)
    assert whole.keys() == texts.keys()
    for doc, parts in whole.items():
        expected = sorted(x for t in texts[doc] for x in enc.encode_ordinary(t) + [end])
        assert sorted(x for _, p in parts for x in p) == expected
        if len(texts[doc]) == 1:
            tokens = [x for _, p in sorted(parts) for x in p]
            assert enc.decode_bytes(tokens[:-1]).decode() == texts[doc][0] and tokens[-1] == end


def test_rows_do_not_depend_on_partitions(spark):
    d = docs(spark, AWKWARD)
    one = sorted(map(str, packing.pack(d.repartition(1), length=64, shard_bytes=50_000).collect()))
    assert one == sorted(map(str, packing.pack(d.repartition(5), length=64, shard_bytes=50_000).collect()))
    assert packing.pack(docs(spark, [])).count() == 0


def test_copies_of_one_row_are_dealt_to_many_shards(spark):
    rows = [(7, "the same row again", "a")] * 600 + [(None, "no id", "a")] * 300 + [(1000 + i, f"row {i}", "b") for i in range(900)]
    d = docs(spark, rows)
    copies = packing.numbered_copies(d.select("doc_id", "text")).collect()
    assert sorted(r.copy for r in copies if r.doc_id == 7) == list(range(1, 601))
    assert sorted(r.copy for r in copies if r.doc_id is None) == list(range(1, 301)) and len(copies) == len(rows)
    packed = packing.pack(d, length=64, shard_bytes=1000).collect()
    per = {}
    for r in packed:
        per[r.shard] = per.get(r.shard, 0) + sum(x == 7 for x in r.segment_docs)
    assert sum(per.values()) == 600 and max(per.values()) < 100
    assert sum(len(r.segment_docs) for r in packed) == len(rows)


def greedy(word, pieces):
    at = n = 0
    data = b" " + word
    while at < len(data):
        k = next((k for k in range(len(data) - at, 0, -1) if data[at : at + k] in pieces), 1)
        at += k
        n += 1
    return n


def test_automaton_equals_greedy_search():
    rng = np.random.default_rng(5)
    for _ in range(30):
        pieces = {bytes(rng.choice(list(b" abc"), int(rng.integers(1, 6))).tolist()) for _ in range(25)}
        count = piece_counts.Counter(*piece_counts.automaton(pieces))
        for _ in range(60):
            word = bytes(rng.choice(list(b"abcd"), int(rng.integers(1, 14))).tolist())
            assert count[word] == greedy(word, pieces)


def test_counts_of_awkward_texts(spark):
    pieces = set(packing.read_vocabulary(packing.VOCABULARY))
    got = piece_counts.token_counts(docs(spark, [r for r in AWKWARD if r[0] != 11])).collect()
    expected = [
        (i, len((t or "").encode().split()), sum(greedy(w, pieces) for w in (t or "").encode().split())) for i, t, _ in AWKWARD if i != 11
    ]
    assert sorted(map(str, ((r.doc_id, r.n_words, r.n_tokens) for r in got))) == sorted(map(str, expected))
    assert piece_counts.token_counts(docs(spark, [])).count() == 0
    assert len(piece_counts.Counter(*piece_counts.automaton(()))) == 0
