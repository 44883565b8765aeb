"""Mixing sources to target weights (operator 9).

The words of a source, its documents in the order of their hashed ids, form one
stream that is cut into blocks of 1/GRAIN of its size or target, whichever is
less, but of 1 to BLOCK words. A mixture is a sequence of slots, dealt to output shards; every shard draws its source counts from a
multinomial distribution, and a source's slots are numbered through the shards.
A keyed pseudorandom permutation of a source's slots picks those beyond its
quota, which go to the sources that drew too little, so the totals meet the
targets to a block of their source. Slot number o of a source takes block
permutation(o mod blocks) in epoch o div blocks, and blocks are joined by that
index. A quota never exceeds MAX_EPOCHS times the source's blocks, hence no
document is taken more often.

Positions come from two levels of about sqrt(rows) buckets, so no source's
prefix sum runs in one task; buckets are dealt by id, size and text, so that
rows of one id (or of none) spread as well. One row per source reaches the driver.

Rows: a text without words (null too) has size 0 and nothing taken; a null
source is a source of its own, last in order; repeated rows are documents of
their own; a null doc_id is allowed; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parlance.llm.common import n_words, store
from parlance.llm.text import blocks, mix

BLOCK = 64
GRAIN = 128
SHARD_SLOTS = 4096
TASK_SLOTS = 200_000
MAX_EPOCHS = 3
WEIGHTS = (5, 2, 1)
SEED = 20


def permute(x: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Where a keyed permutation of range(n) sends x; elementwise, for x < n.

    Four Feistel rounds on the least even number of bits that hold n; values
    outside the range walk on until they come back into it.
    """
    x, n, key = x.astype(np.uint64), n.astype(np.uint64), key.astype(np.uint64)
    half = np.maximum((np.ceil(np.log2(np.maximum(n.astype(float), 2))).astype(np.uint64) + np.uint64(2)) // np.uint64(2), np.uint64(1))
    out, todo = x.copy(), np.arange(len(x))
    while len(todo):
        h, k = half[todo], key[todo]
        low = (np.uint64(1) << h) - np.uint64(1)
        left, right = out[todo] >> h, out[todo] & low
        for r in range(4):
            left, right = right, left ^ (mix(right ^ mix(k + np.uint64(r))) & low)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= n[todo]]
    return out.astype(np.int64)


def targets(sized: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, no, source_size, target, block_words), one row per source.

    Sources in code point order, null last, weigh ``weights`` in turn and share
    all words; a target above max_epochs times the source's words stops there
    and the rest is shared anew by weight, until none is above.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("no") % len(weights) + 1).cast("int"))
    numbered = totals.withColumn("no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    limit = F.lit(float(max_epochs)) * F.col("source_size")
    # By rising limit per weight the sources at their limit come first; the level is that of the first below it.
    order = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("no"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everyone = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everyone) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(onward)
    leveled = numbered.withColumn("w", w).withColumn("cap", limit).withColumn("level", level)
    top = F.max(F.when(F.col("cap") / F.col("w") > F.col("level"), F.col("level"))).over(everyone)
    block_words = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(F.least("source_size", "target") / GRAIN)))
    return leveled.withColumn("target", F.least("cap", F.coalesce(top, F.lit(0.0)) * F.col("w"))).select(
        "source", F.col("no").cast("long").alias("no"), "source_size", "target", block_words.cast("long").alias("block_words")
    )


def _draw(p: np.ndarray, total: int, slots: int):
    def run(batches):
        for batch in batches:
            shard, source, n = [], [], []
            for i in batch.column(0).to_pylist():
                take = min(slots, total - i * slots)
                counts = np.random.Generator(np.random.PCG64([SEED, i])).multinomial(take, p)
                some = np.flatnonzero(counts)
                shard.append(np.full(len(some), i))
                source.append(some)
                n.append(counts[some])
            if shard:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a).astype(np.int64)) for a in (shard, source, n)], ["shard", "no", "n"])

    return run


def _slots(n_blocks, quota, drawn):
    """Source and block of every slot; arguments by source number."""
    surplus, lack = np.maximum(drawn - quota, 0), np.maximum(quota - drawn, 0)
    surplus_at, lack_end = np.cumsum(surplus) - surplus, np.cumsum(lack)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            shard, no, n, start = (batch.column(i).to_numpy() for i in range(4))
            for lo in range(0, len(n), 64):
                part = slice(lo, lo + 64)
                m = n[part]
                s, sh = np.repeat(no[part], m), np.repeat(shard[part], m)
                j = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(start[part], m)
                j = permute(j, drawn[s], s + np.int64(SEED << 40))
                extra = np.flatnonzero(j >= quota[s])
                if len(extra):
                    x = surplus_at[s[extra]] + j[extra] - quota[s[extra]]
                    t = np.searchsorted(lack_end, x, "right")
                    j[extra] = drawn[t] + x - (lack_end[t] - lack[t])
                    s[extra] = t
                epoch = j // n_blocks[s]
                block = permute(j % n_blocks[s], n_blocks[s], (s + np.int64((SEED + 1) << 40)) * 8 + epoch)
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in (sh, s, block, epoch)], ["shard", "no", "block", "epoch"])

    return run


def slots(spark, sources: list) -> DataFrame | None:
    """(shard, no, block, epoch): what each slot of the mixture takes; None if there is nothing to take.

    ``sources``: rows of ``targets`` in the order of their numbers.
    """
    size = np.array([r["source_size"] for r in sources], np.int64)
    target = np.array([r["target"] for r in sources], float)
    n_blocks = np.maximum(-(-size // np.array([r["block_words"] for r in sources], np.int64)), 1)
    quota = np.where(size > 0, np.rint(target / np.maximum(size, 1) * n_blocks), 0).astype(np.int64)
    total = int(quota.sum())
    if not total:
        return None
    per_shard = max(SHARD_SLOTS, int(total**0.5))
    draws = store(
        spark.range(-(-total // per_shard)).mapInArrow(_draw(quota / total, total, per_shard), "shard long, no long, n long"), "draws"
    )
    drawn = np.zeros(len(sources), np.int64)
    for r in draws.groupBy("no").agg(F.sum("n").alias("n")).collect():  # one row per source
        drawn[r["no"]] = r["n"]
    before = Window.partitionBy("no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    numbered = draws.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long"))
    # The rows are few and small but stand for all slots: deal them so that a task makes about TASK_SLOTS.
    numbered = numbered.repartition(-(-total // TASK_SLOTS), "shard")
    return numbered.mapInArrow(_slots(n_blocks, quota, drawn), "shard long, no long, block long, epoch long")


def _placed(rows: DataFrame, sources: DataFrame, buckets: int) -> DataFrame:
    """``rows`` with their source's number and block length and their first word's position in its stream (at)."""
    by = sources.select(F.col("source").alias("of_source"), F.col("no").alias("mix_no"), F.col("block_words").alias("mix_block"))
    rows = rows.join(by, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")
    rows = rows.withColumn("mix_bucket", F.pmod(F.xxhash64("doc_id", "mix_size", "mix_digest", F.lit(SEED)), F.lit(buckets)))
    sums = rows.groupBy("mix_no", "mix_bucket").agg(F.sum("mix_size").alias("mix_sum"))
    before = Window.partitionBy("mix_no").orderBy("mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("mix_base", F.coalesce(F.sum("mix_sum").over(before), F.lit(0))).drop("mix_sum")
    within = Window.partitionBy("mix_no", "mix_bucket").orderBy("doc_id", "mix_size", "mix_digest")
    at = F.col("mix_base") + F.coalesce(F.sum("mix_size").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.join(sums, ["mix_no", "mix_bucket"]).withColumn("mix_at", at.cast("long")).drop("mix_bucket", "mix_base")


class Mixture:
    """The mixture of ``docs``: sources with targets, and how often each block is taken."""

    def __init__(self, docs: DataFrame):
        spark = docs.sparkSession
        self.sized = store(docs.select("doc_id", "source", n_words("text").alias("size"), F.xxhash64("text").alias("mix_digest")), "sized")
        self.sources = store(targets(self.sized), "sources")
        self.buckets = max(1, int(self.sized.count() ** 0.5))
        rows = self.sources.orderBy("no").collect()
        self.slots = slots(spark, rows)
        if self.slots is None:
            self.uses = spark.createDataFrame([], "no long, block long, uses long")
        else:
            self.uses = store(self.slots.groupBy("no", "block").agg(F.count("*").alias("uses")), "uses")

    def pieces(self) -> DataFrame:
        """(mix_no, mix_at, doc_id, mix_size, block, words, uses): the part of each block in each document."""
        rows = _placed(self.sized.withColumnRenamed("size", "mix_size"), self.sources, self.buckets).where("mix_size > 0")
        last = F.col("mix_at") + F.col("mix_size") - 1
        first_block, last_block = F.expr("mix_at div mix_block"), F.expr("(mix_at + mix_size - 1) div mix_block")
        rows = rows.withColumn("block", F.explode(F.sequence(first_block, last_block)))
        words = F.least((F.col("block") + 1) * F.col("mix_block"), last + 1) - F.greatest(F.col("block") * F.col("mix_block"), "mix_at")
        uses = self.uses.withColumnRenamed("no", "mix_no")
        return (
            rows.withColumn("words", words).join(uses, ["mix_no", "block"], "left")
            .select("mix_no", "mix_at", "doc_id", "mix_size", "block", "words", F.coalesce("uses", F.lit(0)).alias("uses"))
        )

    def taken(self) -> DataFrame:
        """(doc_id, size, source_size, target, taken), one row per document."""
        got = self.pieces().groupBy("mix_no", "mix_at", "doc_id", "mix_size").agg(F.sum(F.col("words") * F.col("uses")).alias("taken"))
        per = self.sources.select(F.col("no").alias("mix_no"), "source", "source_size", "target")
        some = got.join(per, "mix_no").select("doc_id", F.col("mix_size").alias("size"), "source_size", "target", "taken")
        none = self.sized.where("size = 0").join(
            per.withColumnRenamed("source", "of_source"), F.col("source").eqNullSafe(F.col("of_source"))
        ).select("doc_id", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"))
        return some.unionByName(none)


def _cut(at: int, counted: int | None):
    """Rows of the taken words: one per epoch, the pieces taken in it in their order."""

    def run(batches):
        for batch in batches:
            n = batch.num_columns - 2
            words, uses = batch.column(n), batch.column(n + 1)
            rows, texts = [], []
            for block in blocks(batch.column(at), False):
                raw = block.data.tobytes()
                for i in range(block.n):
                    row, w = block.lo + i, block.word_at[i]
                    u = np.array(uses[row].values, np.int64)
                    ends = np.cumsum(np.array(words[row].values, np.int64))
                    begin, stop = int(block.offsets[i]), int(block.offsets[i + 1])
                    edge = [begin] + [int(block.starts[w + e]) if w + e < block.word_at[i + 1] else stop for e in ends]
                    for epoch in range(1, int(u.max()) + 1):
                        take = u >= epoch
                        runs, k = [], 0
                        while k < len(u):
                            if take[k]:
                                j = k
                                while j < len(u) and take[j]:
                                    j += 1
                                runs.append(raw[edge[k] : edge[j]])
                                k = j
                            k += 1
                        rows.append(row)
                        texts.append((runs[0] if take.all() else b"\n".join(r.strip(b" \t\n\r\x0b\x0c") for r in runs)).decode())
            if rows:
                out = pa.RecordBatch.from_arrays(batch.columns[:n], batch.schema.names[:n]).take(pa.array(rows, pa.int64()))
                out = out.set_column(at, batch.schema.names[at], pa.array(texts, pa.string()))
                if counted is not None:
                    out = out.set_column(counted, batch.schema.names[counted], pa.array([len(t) for t in texts], batch.schema.types[counted]))
                yield out

    return run


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mixture as documents: a row per document and epoch with the words taken, same columns.

    Pieces that are not neighbours in the document are joined by a new line;
    n_chars, where there is such a column, counts the new text.
    """
    mixture = Mixture(docs)
    plan = mixture.pieces().groupBy("mix_no", "mix_at").agg(
        F.sort_array(F.collect_list(F.struct("block", "words", "uses"))).alias("mix_p"), F.max("uses").alias("mix_max")
    )  # as long as the document
    plan = store(plan.where("mix_max > 0").select("mix_no", "mix_at", "mix_p"), "plan")
    # Other columns ride along under names of their own, whatever they are called.
    other = {c: f"other_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "source", "text")}
    rows = docs.select("doc_id", "source", "text", *(F.col(f"`{c}`").alias(n) for c, n in other.items()), n_words("text").alias("mix_size"))
    rows = _placed(rows.withColumn("mix_digest", F.xxhash64("text")), mixture.sources, mixture.buckets).where("mix_size > 0").join(plan, ["mix_no", "mix_at"])
    rows = rows.select(
        *(F.col(other.get(c, c)).alias(c) for c in docs.columns), F.col("mix_p.words").alias("mix_words"), F.col("mix_p.uses").alias("mix_uses")
    )
    counted = docs.columns.index("n_chars") if "n_chars" in docs.columns else None
    return rows.mapInArrow(_cut(docs.columns.index("text"), counted), docs.schema)
