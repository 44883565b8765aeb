"""Phrase collocation mining with mergeable Misra-Gries summaries (operator 11).

Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends and
into words at blanks and tabs. For every language (null: ``und``), phrases of
2 to 4 words with a = f(phrase) >= ``least`` are candidates. The score is that
of the worst cut into two parts: floor(2000000 * a / (f(first) + f(rest))), ties
to the earliest cut. Candidates contained in a longer candidate with at least
80 % of their count are dropped; the best ``top`` of a language are returned.

1. Phrases of 1 to 4 words are hashed; the leading part of the hash is a hash
   partition, of which there are so many that each has about MASS occurrences.
   Tasks sum the counts of equal phrases in a bounded buffer and send each
   partition a Misra-Gries summary, which holds the other 32 hash bits.
2. The summaries of a partition are merged with a capacity k of mass / least
   counters: what exceeds k loses the (k+1)-th largest count. The count lost,
   in all less than ``least``, is kept as the error, so every phrase with
   f >= least survives: the ones with counter + error >= least. Equal hash bits
   only add survivors.
3. Survivors are marks in a filter of at most FILTER bits, the same for any
   input; as it fills, more phrases pass, and none is lost.
4. A second pass over the texts counts exactly what passes, by the phrase
   itself: tasks sum first and send each hash partition one row of lists.

Memory of a task: its buffer and the filter, or one partition's lists.

Rows: a null text is empty; repeated rows count each time; a text without words
adds nothing; of equal scores the more frequent, then the lesser phrase in UTF-8
order comes first; ids and other columns are not read. An empty table gives an
empty result. Equality of phrases inside a task's buffer is that of 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parlance.llm.common import store
from parlance.llm.text import Block, blocks, mix

LONGEST = 4
#: Occurrences of phrases in a hash partition, about, and in a task's buffer.
MASS = 1 << 22
BUFFER = 1 << 21
#: Bits of the survivors' filter (16 MB), and of a partition's share of it at most.
FILTER = 1 << 27
SHARE = 1 << 22
#: Different phrases that a task counts exactly before it sends them on.
PHRASES = 1 << 20
#: Rows of a batch that a task returns.
ROWS = 16
#: Counters that are merged before a cut, as a multiple of the capacity.
TOGETHER = 8
#: Bytes of text to a word, for the number of hash partitions only.
BYTES = 6
#: What ends a piece reads as a line end, upper case as lower case.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[[0x2E, 0x2C, 0x3B, 0x3A, 0x21, 0x3F, 0x0A, 0x0B, 0x0C, 0x0D]] = 0x0A
FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)


def _folded(column: pa.Array) -> Iterator[Block]:
    """Blocks of the texts, lower-cased and with pieces ended by line ends."""
    for block in blocks(column, False):
        yield Block(FOLD[block.data], block.offsets, block.lo, False)


def _phrases(block: Block, salts: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, first words, hashes) of all phrases of n words; ``salts`` tell the rows' languages apart."""
    row = np.repeat(np.arange(block.n), np.diff(block.word_at))
    piece = np.cumsum(block.data == 0x0A)[block.starts] + row if len(block.starts) else row
    total = salts[block.lo + row] if len(row) else np.zeros(0, np.uint64)
    for n in range(1, LONGEST + 1):
        last = len(row) - n + 1
        if last <= 0:
            return
        with np.errstate(over="ignore"):
            total = total[:last] + block.hashes[n - 1 :] * np.uint64(pow(0x2545F4914F6CDD1D, n, 1 << 64))
        first = np.flatnonzero(piece[:last] == piece[n - 1 :])
        yield n, first, mix(total[first] + np.uint64(n))


def _salts(langs: pa.Array) -> np.ndarray:
    """A 64-bit value per row, the same for equal languages."""
    names = langs.dictionary_encode()
    words = [int.from_bytes(x.encode()[-64:].rjust(64, b"\0"), "big") for x in names.dictionary.to_pylist()]
    known = np.array([sum((w >> s & (1 << 64) - 1) * pow(0x9E3779B97F4A7C15, s + 1, 1 << 64) for s in range(0, 512, 64)) & (1 << 64) - 1 for w in words], np.uint64)
    return mix(known)[names.indices.to_numpy()]


def _place(h: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash partition, 32 other bits) of phrase hashes."""
    return ((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32), h & np.uint64(0xFFFFFFFF)


def merged(summaries: list[tuple[np.ndarray, np.ndarray]], capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(keys, counters, error) of the Misra-Gries summaries (keys, counters) as one of at most ``capacity`` counters."""
    keys, counts, error = np.zeros(0, np.uint32), np.zeros(0, np.int64), 0
    held, size = [], 0
    last = len(summaries) - 1
    for i, summary in enumerate(summaries):
        held.append(summary)
        size += len(summary[0])
        if size < TOGETHER * capacity and i < last:
            continue
        # Many at once: each cut adds to the error.
        more, n = map(np.concatenate, zip((keys, counts), *held, strict=True))
        keys, at = np.unique(more, return_inverse=True)
        counts = np.bincount(at, n, len(keys)).astype(np.int64)
        held, size = [], 0
        if len(keys) > capacity:
            cut = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
            error += cut
            keys, counts = keys[counts > cut], counts[counts > cut] - cut
    return keys, counts, error


def _summaries(parts: int):
    """(part, keys, counts): summaries of the phrases of (lang, text), one per hash partition and buffer."""

    def sent(buffer: list) -> pa.RecordBatch:
        h = np.sort(np.concatenate(buffer))
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        counts = np.diff(np.concatenate([first, [len(h)]])).astype(np.uint32)
        part, key = _place(h[first], parts)
        found, at = np.unique(part, return_index=True)
        edges = [*at.tolist(), len(part)]
        key, each = key.astype(np.uint32), list(zip(edges, edges[1:]))
        return pa.RecordBatch.from_arrays(
            [pa.array(found.astype(np.int64)), pa.array([key[i:j].tobytes() for i, j in each], pa.binary()), pa.array([counts[i:j].tobytes() for i, j in each], pa.binary())],
            ["part", "keys", "counts"],
        )

    def run(batches):
        buffer, held = [], 0
        for batch in batches:
            salts = _salts(batch.column(0))
            for block in _folded(batch.column(1)):
                for _, _, h in _phrases(block, salts):
                    buffer.append(h)
                    held += len(h)
                if held >= BUFFER:
                    yield sent(buffer)
                    buffer, held = [], 0
        if held:
            yield sent(buffer)

    return run


def _survivors(least: int, share: int):
    """(part, marks): the partition's share of the filter."""

    def run(group: pa.Table) -> pa.Table:
        rows = [(np.frombuffer(k, np.uint32), np.frombuffer(n, np.uint32)) for k, n in zip(*(group.column(c).to_pylist() for c in ("keys", "counts")), strict=True)]
        mass = sum(int(n.sum(dtype=np.int64)) for _, n in rows)
        keys, counts, error = merged(rows, mass // least + 1)
        marks = np.zeros(share, np.uint8)
        marks[(keys[counts + error >= least].astype(np.uint64) * np.uint64(share)) >> np.uint64(32)] = 1
        return pa.table({"part": group.column("part")[:1], "marks": pa.array([np.packbits(marks).tobytes()], pa.binary())})

    return run


class _Tally:
    """Exact counts of different phrases by hash, each with (lang, n, phrase), kept sorted in arrays."""

    def __init__(self):
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.n, self.lang, self.phrase = np.zeros(0, np.int32), np.zeros(0, object), np.zeros(0, object)

    def add(self, keys: np.ndarray, counts: np.ndarray, n: int, name) -> None:
        """Sorted distinct ``keys`` of phrases of n words; ``name(which)`` gives languages and phrases of new ones."""
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        known[at < len(self.keys)] = self.keys[at[at < len(self.keys)]] == keys[at < len(self.keys)]
        self.counts[at[known]] += counts[known]
        new = np.flatnonzero(~known)
        if len(new):
            lang, phrase = name(new)
            put = lambda old, more: np.insert(old, at[new], more)
            self.keys, self.counts, self.n = put(self.keys, keys[new]), put(self.counts, counts[new]), put(self.n, np.int32(n))
            self.lang, self.phrase = put(self.lang, lang), put(self.phrase, phrase)

    def rows(self, parts: int) -> Iterator[pa.RecordBatch]:
        """A row per hash partition, with the lists of its phrases."""
        part, _ = _place(self.keys, parts)  # sorted, as the keys are
        found, first = np.unique(part, return_index=True)
        yield from _rows(found.astype(np.int64), [*first.tolist(), len(part)], self.lang, self.n, self.phrase, self.counts)


LISTS = ("lang", "n", "phrase", "f")


def _rows(part, edges, lang, n, phrase, f) -> Iterator[pa.RecordBatch]:
    text = pa.array(phrase, pa.binary()).cast(pa.string())
    values = (pa.array(lang, pa.string()), pa.array(n, pa.int32()), text, pa.array(f, pa.int64()))
    lists = [pa.ListArray.from_arrays(pa.array(edges, pa.int32()), v) for v in values]
    batch = pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), *lists], ["part", *LISTS])
    for i in range(0, batch.num_rows, ROWS):
        yield batch.slice(i, ROWS)


def _summed(least: int):
    """The exact counts of a hash partition's phrases, of those with f >= least, and of words (n = 0)."""

    def run(group: pa.Table) -> pa.Table:
        flat = pa.table({c: pc.list_flatten(group.column(c)) for c in LISTS})
        total = flat.group_by(["lang", "n", "phrase"]).aggregate([("f", "sum")]).rename_columns({"f_sum": "f"})
        return total.filter(pc.or_(pc.equal(total["n"], 0), pc.greater_equal(total["f"], least))).select(LISTS)

    return run


def _objects(values: list) -> np.ndarray:
    out = np.empty(len(values), object)
    out[:] = values
    return out


def _counted(parts: int, share: int, marks):
    """(part, lang, n, phrase, f), a row per hash partition: exact counts of the phrases that pass the filter; n = 0 counts all words."""

    def run(batches):
        tally, words = _Tally(), {}
        for batch in batches:
            langs, salts = _objects(batch.column(0).to_pylist()), _salts(batch.column(0))
            for block in _folded(batch.column(1)):
                row_of = np.repeat(np.arange(block.n), np.diff(block.word_at)) + block.lo
                blank = np.concatenate([np.flatnonzero(~block.solid), [len(block.data)]])
                ends = np.minimum(blank[np.searchsorted(blank, block.starts)], block.offsets[1:][row_of - block.lo])
                for row, count in zip(*np.unique(row_of, return_counts=True)):
                    words[langs[row]] = words.get(langs[row], 0) + int(count)
                data = block.data.tobytes()
                for n, first, h in _phrases(block, salts):
                    part, key = _place(h, parts)
                    bit = (part * np.uint64(share) + ((key * np.uint64(share)) >> np.uint64(32))).astype(np.int64)
                    ok = (marks.value[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1 > 0
                    kept, at, count = np.unique(h[ok], return_index=True, return_counts=True)
                    where = first[ok][at]

                    def name(which, n=n, where=where):
                        i = where[which]
                        spans = zip(block.starts[i].tolist(), ends[i + n - 1].tolist())
                        return langs[row_of[i]], _objects([b" ".join(data[x:y].split()) for x, y in spans])

                    tally.add(kept, count, n, name)
                if len(tally.keys) > PHRASES:
                    yield from tally.rows(parts)
                    tally = _Tally()
        yield from tally.rows(parts)
        yield from _rows([0], [0, len(words)], list(words), [0] * len(words), [b""] * len(words), list(words.values()))

    return run


def counts(docs: DataFrame, least: int) -> DataFrame:
    """(lang, n, phrase, f) of all phrases of 1 to 4 words with f >= least, and per lang its words (n = 0)."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text")).alias("size")).first().size or 0
    parts = max(1, -(-LONGEST * size // (BYTES * MASS)))
    share = max(8, min(SHARE, FILTER // parts) // 8 * 8)
    summaries = texts.mapInArrow(_summaries(parts), "part long, keys binary, counts binary")
    found = summaries.groupBy("part").applyInArrow(_survivors(least, share), "part long, marks binary")
    marks = np.zeros(parts * share // 8, np.uint8)
    for row in found.collect():  # the filter's bits: bounded
        at = row.part * share // 8
        marks[at : at + share // 8] = np.frombuffer(row.marks, np.uint8)
    lists = "lang array<string>, n array<int>, phrase array<string>, f array<long>"
    passed = texts.mapInArrow(_counted(parts, share, spark.sparkContext.broadcast(marks)), f"part long, {lists}")
    return store(passed.groupBy("part").applyInArrow(_summed(least), "lang string, n int, phrase string, f long"), "phrases")


def _parts(phrases: DataFrame, sizes: F.Column) -> DataFrame:
    """The phrases with ``word``, their words, and a row for each element ``k`` of ``sizes``."""
    return phrases.withColumn("word", F.split("phrase", " ")).withColumn("k", F.explode(sizes))


def scored(phrases: DataFrame) -> DataFrame:
    """(lang, n, phrase, a, l, r, score) of the candidates among counted phrases."""
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    joined = lambda start, length: F.array_join(F.slice("word", start, length), " ")
    cuts = _parts(phrases.where("n > 1").withColumnRenamed("f", "a"), F.sequence(F.lit(1), F.col("n") - 1))
    cuts = cuts.select("lang", "n", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("first"), joined(F.col("k") + 1, F.col("n") - F.col("k")).alias("rest"))
    known = phrases.where("n > 0")
    one = known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    two = known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    cuts = cuts.join(one, ["lang", "first"]).join(two, ["lang", "rest"])
    cuts = cuts.withColumns({"up": exact("a") * F.lit(2_000_000).cast("decimal(7,0)"), "down": exact("l") + exact("r")})
    worst = F.min(F.struct(F.expr("up div down").alias("score"), "k", "l", "r")).alias("cut")
    return cuts.groupBy("lang", "n", "phrase", "a").agg(worst).select("lang", "n", "phrase", "a", "cut.l", "cut.r", "cut.score")


def covered(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, most): phrases of 2 words or more inside longer candidates, with the largest count of these."""
    longer = _parts(phrases.where("n > 2"), F.sequence(F.lit(2), F.col("n") - 1))
    inside = longer.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n") - F.col("k") + 1)))
    part = F.array_join(F.slice("word", F.col("i"), F.col("k")), " ").alias("phrase")
    return inside.select("lang", part, "f").groupBy("lang", "phrase").agg(F.max("f").alias("most"))


def collocations(docs: DataFrame, least: int = 30, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of every language."""
    phrases = counts(docs, least)
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    kept = scored(phrases).join(covered(phrases), ["lang", "phrase"], "left")
    kept = kept.where(F.col("most").isNull() | (exact("most") * 100 < exact("a") * 80))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    words = phrases.where("n = 0").select("lang", F.col("f").alias("n"))
    return best.drop("n").join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
