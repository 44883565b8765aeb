"""Benchmark passages inside documents (operator 7).

A test item is contained in a document when at least 80 % of its distinct
``width``-word shingles (lower-cased A-Z) occur in the document; an item of
fewer words is one shingle of all its words.

Documents are partitioned by the size of their shingle set, and a partition's
MinHash signature has as many registers as its largest set has shingles, times
two: one-permutation hashing with a load of at most one half, so a short item
inside a document of any length still meets its own minima there. Registers
equal to the item's give the candidates, with a bound five standard deviations
below what 80 % containment leads one to expect; candidates are then verified
on the whole shingle sets, in the same task, so no text is shuffled. A register
keeps a shingle with a chance of 0.79 or more, so an item of few shingles could
lose them all: items are partitioned by size too, and those of fewer than FEW
are looked up with a register per shingle, the whole set. Others are missed with
a chance below 0.22 ** 13.

Items are sent to the tasks in blocks of about BLOCK_SHINGLES shingles, one
pass over the documents per block, so what is broadcast stays bounded however
large the benchmark is. Items with equal shingle sets are searched for once,
and a hit gives a pair with the id of each; a set of more than about IDS ids is
searched for once per so many.

Rows: null and empty texts contain nothing, and items without words are in no
document; repeated documents answer each for itself; null doc_ids are carried
through. As in the SQL, an item with a null id gives no pair; a document that
contains it is not clean all the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import store
from parlance.llm.text import blocks, mix, row_sets

WIDTH = 5
PERCENT = 80
BLOCK_SHINGLES = 2_000_000
IDS = 10_000
OUT_ROWS = 100_000
FEW = 16


def _items(width: int):
    def run(batches):
        for batch in batches:
            words, sets, d1, d2 = [], [], [], []
            for block in blocks(batch.column(1), True):
                words += [min(width, int(n)) for n in np.diff(block.word_at)]
                for _, s in row_sets(block, width):
                    sets.append(s.view(np.int64))
                    with np.errstate(over="ignore"):
                        d1.append(int(np.add.reduce(mix(s)).view(np.int64)) if len(s) else 0)
                        d2.append(int(np.bitwise_xor.reduce(mix(~s)).view(np.int64)) if len(s) else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int32()), pa.array(sets, pa.list_(pa.int64())), pa.array(d1, pa.int64()), pa.array(d2, pa.int64())],
                ["item_id", "width", "shingles", "d1", "d2"],
            )

    return run


def arrays(rows: list, width: int, few: bool) -> tuple:
    """The shingles of items (ids, shingles) of one width and size class, sorted, with the items that hold each."""
    sizes = np.array([len(r[1]) for r in rows], np.int64)
    every = np.concatenate([r[1] for r in rows])
    owner = np.repeat(np.arange(len(rows)), sizes)
    order = np.lexsort((owner, every))
    hashes, first = np.unique(every[order], return_index=True)
    return width, few, [r[0] for r in rows], sizes, owner[order], hashes, np.append(first, len(every))


class Index:
    """Search in what ``arrays`` returns."""

    def __init__(self, width, few, ids, sizes, owner, hashes, at):
        self.width, self.few, self.ids, self.sizes = width, few, ids, sizes
        self.owner, self.hashes, self.at = owner, hashes, at

    def _hits(self, s: np.ndarray) -> np.ndarray:
        """How many of the values ``s`` each item holds."""
        i = np.searchsorted(self.hashes, s)
        i = i[self.hashes[np.minimum(i, len(self.hashes) - 1)] == s]
        count = np.zeros(len(self.ids), np.int64)
        for k in i:
            count[self.owner[self.at[k] : self.at[k + 1]]] += 1
        return count

    def search(self, block):
        """(row number, item number, common shingles) of contained items."""
        sets, signatures = [], []
        shingles, at = block.shingles(self.width)
        for i in range(block.n):
            s = np.sort(shingles[at[i] : at[i + 1]])
            sets.append(s)
            signatures.append(np.unique(s) if self.few else signature(s))
        if not sets:
            return
        every = np.concatenate(signatures)
        i = np.searchsorted(self.hashes, every)
        met = self.hashes[np.minimum(i, len(self.hashes) - 1)] == every
        ends = np.cumsum([len(x) for x in signatures])
        for row in np.unique(np.searchsorted(ends, np.flatnonzero(met), "right")):
            s = sets[row]
            count = self._hits(signatures[row])
            load = min(len(s) / registers(len(s)), 1.0)
            stay = 1.0 if self.few else (1 - np.exp(-load)) / load  # chance that a shingle is the least of its register
            expect = PERCENT / 100 * self.sizes * stay
            likely = count >= np.maximum(1, expect - 5 * np.sqrt(expect * (1 - stay) + 1))
            if likely.any():
                common = self._hits(np.unique(s))
                for item in np.flatnonzero(likely & (100 * common >= PERCENT * self.sizes)):
                    yield block.lo + int(row), int(item), int(common[item])


def registers(n: int) -> int:
    """Signature length of the size partition that a set of n shingles is in."""
    return 2 << max(int(n) - 1, 0).bit_length()


def signature(s: np.ndarray) -> np.ndarray:
    """The least hash of every register that the sorted set fills."""
    if len(s) < 2:
        return s
    shift = np.uint64(65 - registers(len(s)).bit_length())
    bucket = s >> shift
    return s[np.concatenate([[True], bucket[1:] != bucket[:-1]])]


def _indexes(items: DataFrame, block: int) -> list[tuple]:
    """Of one block of items, whose size is bounded by the number of blocks."""
    rows = items.where(F.col("block") == block).orderBy("d1", "d2", "width", "chunk").select("ids", "width", "shingles").toArrow()
    by: dict = {}
    for ids, width, s in zip(*(rows.column(i) for i in range(3)), strict=True):
        by.setdefault((width.as_py(), len(s) < FEW), []).append((np.array(ids.values, np.int64), np.array(s.values, np.int64).view(np.uint64)))
    return [arrays(v, *k) for k, v in sorted(by.items())]


def item_blocks(benchmark: DataFrame, width: int = WIDTH, block_shingles: int = BLOCK_SHINGLES, *, ids: bool):
    """The broadcast variables, one per block of items, with the ids of all items of each set or with none."""
    spark = benchmark.sparkSession
    kind = benchmark.schema["item_id"].dataType.simpleString()
    same = ["d1", "d2", "width"]
    sets = benchmark.select("item_id", "text").mapInArrow(
        _items(width), f"item_id {kind}, width int, shingles array<long>, d1 long, d2 long"
    ).where("size(shingles) > 0")
    items = store(sets.groupBy(*same).agg(F.count("item_id").alias("copies"), F.first("shingles").alias("shingles")), "items")
    if ids:
        members = sets.where("item_id is not null").select(*same, "item_id").distinct().join(items.select(*same, "copies"), same)
        chunk = F.pmod(F.xxhash64("item_id"), F.ceil(F.col("copies") / IDS))
        members = members.groupBy(*same, chunk.alias("chunk")).agg(F.collect_list("item_id").alias("ids"))
        items = store(members.join(items.select(*same, "shingles"), same), "members")
    else:
        items = items.select(*same, F.lit(0).alias("chunk"), F.array().cast("array<long>").alias("ids"), "shingles")
    total = items.agg(F.sum(F.size("shingles") + F.size("ids"))).first()[0] or 0
    n = -(-total // block_shingles)
    items = items.withColumn("block", F.pmod(F.xxhash64("d1", "d2", "chunk"), F.lit(max(n, 1))))
    for block in range(n):
        yield spark.sparkContext.broadcast(_indexes(items, block))


def _pairs(sent):
    def table(ids, found):
        """The hits (row, ids, n_item, n_common) as columns, a row for every id."""
        each = np.array([len(x[1]) for x in found])
        rows, sizes, common = (np.repeat(np.array([x[i] for x in found], np.int64), each) for i in (0, 2, 3))
        items = np.concatenate([x[1] for x in found])
        return pa.RecordBatch.from_arrays(
            [ids.take(pa.array(rows)), pa.array(items), pa.array(sizes), pa.array(common)], ["doc_id", "item_id", "n_item", "n_common"]
        )

    def run(batches):
        indexes = [Index(*x) for x in sent.value]
        for batch in batches:
            found, n = [], 0
            for block in blocks(batch.column(1), True):
                for index in indexes:
                    for row, item, common in index.search(block):
                        found.append((row, index.ids[item], int(index.sizes[item]), common))
                        n += len(index.ids[item])
                        if n >= OUT_ROWS:
                            yield table(batch.column(0), found)
                            found, n = [], 0
            if found:
                yield table(batch.column(0), found)

    return run


def contained_items(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, item_id, n_item, n_common): the test items that each document contains."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id long, n_item long, n_common long"
    found = [
        docs.select("doc_id", "text").mapInArrow(_pairs(sent), schema)
        for sent in item_blocks(benchmark.withColumn("item_id", F.col("item_id").cast("long")), width, ids=True)
    ]
    if not found:
        return spark.createDataFrame([], schema)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _clean(sent, at: int):
    def run(batches):
        indexes = [Index(*x) for x in sent.value]
        for batch in batches:
            bad = np.zeros(batch.num_rows, bool)
            for block in blocks(batch.column(at), True):
                for index in indexes:
                    for row, _, _ in index.search(block):
                        bad[row] = True
            yield batch.filter(pa.array(~bad))

    return run


def without_items(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents that contain no test item, all columns as they are."""
    for sent in item_blocks(benchmark.withColumn("item_id", F.col("item_id").cast("long")), width, ids=False):
        docs = docs.mapInArrow(_clean(sent, docs.columns.index("text")), docs.schema)
    return docs
