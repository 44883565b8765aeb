import base64
import gzip
import hashlib
import os
import random

import pytest

from parlance.llm import common, preference, warc

PAGES = "page_id long, url string, html string, sha string, value string, file string, first long"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", 1) for r in rows], PAGES)


def expected(rows):
    groups = {}
    for i, _, h in rows:
        groups.setdefault(h or "", []).append(i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        ids = [x for x in groups[h or ""] if x is not None]
        first = max(ids) if ids and len(groups[h or ""]) > 1 else None
        revisit = first is not None and i != first
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


ROWS = [
    (1, "http://a.org/", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "http://b.org/a b\r\nX: y", None), (4, "u", ""), (5, "u", "x" * 100_000),
    (7, "u", "same"), (7, "u", "same"), (6, "v", "same"), (None, "u", "same"), (None, None, "alone"), (8, "u", "WARC/1.1\r\n\r\n\r\n"),
]


def test_round_trip_of_awkward_rows(spark):
    assert result(warc.round_trip(pages(spark, ROWS))) == expected(ROWS)
    assert warc.round_trip(pages(spark, [])).count() == 0


def test_small_payloads_are_all_responses(spark):
    got = warc.round_trip(pages(spark, ROWS), min_bytes=5).where("payload_bytes < 5").collect()
    assert len(got) == 6 and all(r.record_type == "response" and r.refers_to is None for r in got)


def test_files_are_plain_gzip_members_and_payloads_come_back(spark):
    path = common.folder(spark, "warc")
    big = "".join(random.Random(1).choices("abcdefgh \n", k=1000)) * 17_000  # a record of over 16 MiB
    rows = [*ROWS, (9, "big", big)]
    warc.write(pages(spark, rows).coalesce(2), path)
    data = b"".join(gzip.open(f"{path}/{f}".removeprefix("file:")).read() for f in sorted(os.listdir(path.removeprefix("file:"))) if f.startswith("part-"))
    assert data.count(b"WARC/1.1\r\nWARC-Type: ") == len(rows)
    got = warc.read(spark, path)
    assert result(got) == expected(rows)
    payloads = {r.page_id: bytes(r.payload) for r in got.where("record_type = 'response'").collect()}
    assert payloads[9] == big.encode() and payloads[5] == b"x" * 100_000 and payloads[2] == "<p>é</p>".encode()


def test_ranges_of_any_size_and_false_magic(spark):
    """Payloads that do not compress hold the magic as plain bytes; ranges end anywhere."""
    rng = random.Random(2)
    rows = []
    for i in range(120):
        noise = "".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(rng.randrange(10, 900)))
        rows.append((i, "u", "\x1f\x8b\x08" + noise + "\x1f\x8b\x08\x00" * rng.randrange(3)))
    path = common.folder(spark, "warc")
    # Stored, not deflated: the payload's bytes stand in the file as they are.
    level, warc.LEVEL = warc.LEVEL, 0
    raw = []
    try:
        for i, url, html in rows:
            data = warc.member(warc.record(i, url, html.encode("latin1", "ignore") + warc.MAGIC * 3 + bytes([i, 7]), None, "d"))
            raw.append(data if not data[-1] else data + warc.member(b""))
    finally:
        warc.LEVEL = level
    spark.createDataFrame([(x[:-1],) for x in raw], "value binary").coalesce(1).selectExpr("cast(value as string) value").write.option("lineSep", "\0").text(path)
    held = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        for size in (97, 333, 1009, 1 << 20):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            got = warc.read(spark, path).collect()
            assert sorted(r.page_id for r in got) == list(range(120)), size
            assert all(bytes(r.payload).endswith(warc.MAGIC * 3 + bytes([r.page_id, 7])) for r in got)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held[0])
        spark.conf.set("spark.sql.files.openCostInBytes", held[1])


def pair(spark, chosen, rejected):
    turns = "array<struct<role:string,text:string>>"
    df = spark.createDataFrame([(1, chosen, rejected)], f"pair_id long, chosen {turns}, rejected {turns}")
    return preference.format_pairs(df).first()


def test_longest_common_prefix_and_masks(spark):
    u, a, b = ("user", "hi"), ("assistant", "yes"), ("assistant", "no!")
    r = pair(spark, [u, a, ("user", "q"), a], [u, a, ("user", "z"), b, u])
    assert r.n_prompt_turns == 2 and r.usable
    assert r.prompt == "<|user|>\nhi<|end|>\n<|assistant|>\nyes<|end|>\n"
    assert r.chosen == "<|user|>\nq<|end|>\n<|assistant|>\nyes<|end|>\n"
    assert r.chosen_mask == "0" * (9 + 1 + 8) + "0" * 14 + "1" * (3 + 8)
    assert len(r.rejected) == len(r.rejected_mask) and r.rejected_mask.count("1") == 11


def test_equal_and_nested_conversations(spark):
    u, a = ("user", "hi"), ("assistant", "yes")
    same = pair(spark, [u, a], [u, a])
    assert (same.n_prompt_turns, same.chosen, same.rejected, same.usable) == (2, "", "", False)
    longer = pair(spark, [u], [u, a])
    assert (longer.n_prompt_turns, longer.chosen, longer.usable) == (1, "", False) and longer.rejected.startswith("<|assistant|>")
    shorter = pair(spark, [u, a], [u])
    assert (shorter.n_prompt_turns, shorter.rejected, shorter.rejected_mask, shorter.usable) == (1, "", "", False)
    none = pair(spark, [], [])
    assert (none.n_prompt_turns, none.prompt, none.usable) == (0, "", False)


def test_pairs_from_awkward_conversations(spark):
    rows = [
        (0, 0, "user", "hi"), (0, 1, "assistant", "one"), (0, 2, "user", "bye"), (1, 1, "assistant", "two"), (1, 0, None, None),
        (2, 0, "user", "alone"), (3, 0, "assistant", "x"), (4, 0, "assistant", "same"), (5, 0, "assistant", "same"),
        (None, 0, "assistant", "lost"), (6, 0, "assistant", None), (7, 0, "assistant", "y"), (7, 0, "assistant", "y"),
    ]
    turns = spark.createDataFrame([(*r, "k", 1) for r in rows], "conv_id long, turn long, role string, text string, turns string, last int")
    got = {r.pair_id: r for r in preference.format_pairs(preference.crossed_endings(turns)).collect()}
    answered = {r[0] for r in rows if r[2] == "assistant" and r[0] is not None}
    assert set(got) == answered and len(got) > 3
    assert preference.format_pairs(preference.crossed_endings(turns.where("false"))).count() == 0
    assert preference.format_pairs(preference.crossed_endings(turns.where("conv_id = 6"))).count() == 0  # no neighbour


def crossed(convs):
    """The pairs by plain lists: {id: (prompt turns, chosen rest, rejected rest)}."""
    at = {c: [i for i, (role, _) in enumerate(t) if role == "assistant"] for c, t in convs.items()}
    at = {c: i[(len(i) + 1) // 2 - 1] for c, i in at.items() if i}
    ids, out = sorted(at), {}
    for k, c in enumerate(ids):
        mate = ids[k - 1] if k % 2 or k == len(ids) - 1 else ids[k + 1]
        yes, no = convs[c], convs[c][: at[c]] + convs[mate][at[mate] :]
        n = 0
        while n < min(len(yes), len(no)) and yes[n] == no[n]:
            n += 1
        out[c] = (n, yes[n:], no[n:])
    return out


@pytest.mark.parametrize("step", [1, 2, 1000])
def test_every_answered_conversation_gives_one_whole_pair(spark, step):
    rng = random.Random(step)
    said = ["Yes.", "No.", "Why?", "Ok."]
    convs = {step * c: [(rng.choice(["user", "assistant"]), rng.choice(said)) for _ in range(rng.randrange(1, 9))] for c in range(41)}
    rows = [(c, i, role, text) for c, turns in convs.items() for i, (role, text) in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.pair_id: r for r in preference.format_pairs(preference.crossed_endings(df)).collect()}
    want = crossed(convs)
    assert set(got) == set(want) == {c for c, t in convs.items() if any(role == "assistant" for role, _ in t)}
    show = lambda turns: "".join(f"<|{role}|>\n{text}<|end|>\n" for role, text in turns)
    marks = lambda turns: "".join("0" * (len(role) + 5) + ("1" if role == "assistant" else "0") * (len(text) + 8) for role, text in turns)
    for c, (n, yes, no) in want.items():
        r = got[c]
        assert (r.n_prompt_turns, r.prompt, r.chosen, r.rejected) == (n, show(convs[c][:n]), show(yes), show(no))
        assert (r.chosen_mask, r.rejected_mask, r.usable) == (marks(yes), marks(no), bool(yes and no))
    assert max(len(yes) for _, yes, _ in want.values()) > 2 and max(n for n, _, _ in want.values()) > 2
