"""MinHash near-duplicates with HyperMinHash registers (operator 1).

A document is the set of its distinct ``ngram``-word shingles (lower-cased A-Z;
fewer words: the whole sequence as one shingle; no word: the empty set, linked
with nothing). Two documents are linked when 100 * |A n B| >= 80 * |A u B|,
confirmed on full shingle sets; groups are the connected components.

1. Each set is compressed to REGISTERS HyperMinHash registers. The top bits of
   a shingle's hash choose the register, which keeps the leading-zero count and
   the next MANTISSA bits of the least remaining hash. Equal sets (128-bit
   digest) collapse to one representative.
2. The compressed registers are cut into BANDS bands of ROWS. Empty registers
   of small sets borrow from a register chosen by a fixed pseudorandom order.
   Documents sharing a band are in a bucket. At similarity 0.8 a pair shares no
   bucket with probability (1 - 0.8 ** ROWS) ** BANDS = 3e-6.
3. Every bucket is linked as a star around its least id: one candidate per
   membership, whatever the size. Candidates pass the size filter and the
   collision-corrected register estimate (five standard deviations below 0.8),
   then the exact check.
4. Buckets whose members still carry different labels are searched further, so
   a link between two non-centres is not lost, on one path whatever their size.
   Members are written as changes (shingles lost, shingles added) against one
   reference set R for all buckets of a family (those with the same largest
   group): the shingles that more than half of a bounded sample of its members
   have. Any R gives the same links; a typical one makes changes few and rare.
   For sets A, B with changes of weight g = (5 * lost + 4 * added) / 9, a
   similarity of 0.8 means exactly that A and B share at least
   g(A) + g(B) - |R| / 9 changes. So the member C of least weight is linked to
   every A with g(A) + g(C) <= |R| / 9: one candidate each. Every other A shares
   more than g(B) - g(C) changes with a partner B: in an order common to all,
   those rare in the sample first, their first common one is at a place after
   which enough are left in both. A join on those finds every such pair without
   comparing all. Pairs just below 0.8 may become candidates too; they are the
   only cost that can grow faster than the memberships. No bucket is capped.

Rows: a null text is empty; every distinct shingle set is a node, whatever the
doc_ids of its rows, so texts that share a doc_id meet only if they are linked,
and texts with a null doc_id link like any others. Where all of a group's
doc_ids are null, so is its component_id. Other columns of the input are read
only to tell rows apart.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parlance.llm.common import quoted, store
from parlance.llm.graph import components
from parlance.llm.text import MASK, blocks, mix, row_sets

REGISTERS = 256
MANTISSA = 10
ROWS = 6
BANDS = REGISTERS // ROWS
EMPTY = 0xFFFF
#: Members of a family whose shingles settle its reference; any reference gives the same links.
TYPICAL = 64
PERCENT = 80
#: What tells a row from others: rows equal in these are equal in all columns. doc_id is an integer.
ROW = ("doc_id", "text_digest", "row_digest")


def _keys_of(docs: DataFrame) -> list[F.Column]:
    """The columns ROW of ``docs``."""
    plain = [f for f in docs.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    hashed = [quoted(f.name) for f in plain]
    return [F.col("doc_id").cast("long").alias(ROW[0]), F.xxhash64("text").alias(ROW[1]), F.xxhash64(*hashed).alias(ROW[2])]


def registers(s: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of a sorted set of hashes; EMPTY where no hash fell.

    Sorted hashes are sorted by register and then by the remaining bits, so a
    register's least hash is the first of its run.
    """
    out = np.full(REGISTERS, EMPTY, np.uint16)
    bits = REGISTERS.bit_length() - 1
    bucket = (s >> np.uint64(64 - bits)).astype(np.int64)
    if len(s):
        first = np.concatenate([[True], bucket[1:] != bucket[:-1]])
        rest = (s[first] << np.uint64(bits)) >> np.uint64(bits)
        width = 64 - bits
        lead = width - np.frexp(rest.astype(np.float64))[1]  # leading zeros among the remaining bits
        lead = np.minimum(lead, (1 << (16 - MANTISSA)) - 2)
        shift = np.maximum(width - lead - 1 - MANTISSA, 0).astype(np.uint64)
        mantissa = (rest >> shift) & np.uint64((1 << MANTISSA) - 1)
        out[bucket[first]] = (lead.astype(np.uint64) << np.uint64(MANTISSA)) | mantissa
    return out


def _sketch(ngram: int):
    def run(batches):
        for batch in batches:
            sizes, d1, d2, regs = [], [], [], []
            for block in blocks(batch.column(3), True):
                for _, s in row_sets(block, ngram):
                    sizes.append(len(s))
                    with np.errstate(over="ignore"):
                        d1.append(int(np.add.reduce(mix(s)).view(np.int64)) if len(s) else 0)
                        d2.append(int(np.bitwise_xor.reduce(mix(s ^ np.uint64(0x5851F42D4C957F2D))).view(np.int64)) if len(s) else 0)
                    regs.append(registers(s).tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(sizes, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(regs, pa.binary())],
                [*ROW, "n", "d1", "d2", "regs"],
            )

    return run


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _filled(regs: np.ndarray) -> np.ndarray:
    """Empty registers borrow the value of the first full one in their own fixed order."""
    order = np.stack([np.random.Generator(np.random.PCG64(i)).permutation(REGISTERS) for i in range(REGISTERS)])
    out = regs.copy()
    for row in np.flatnonzero((regs == EMPTY).any(1)):
        full = regs[row] != EMPTY
        need = np.flatnonzero(~full)
        out[row, need] = regs[row, order[need, full[order[need]].argmax(1)]]
    return out


def _keys(regs: np.ndarray) -> np.ndarray:
    """One 64-bit key per row and band."""
    v = _filled(regs)[:, : BANDS * ROWS].astype(np.uint64).reshape(-1, BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), v.shape[:2]).copy()
    for j in range(ROWS):
        key = mix(key ^ (v[:, :, j] + np.uint64((j + 1) * 0x9E3779B97F4A7C15 & MASK)))
    return key


def _bands(batches):
    for batch in batches:
        if batch.num_rows:
            keys = _keys(_matrix(batch.column(1))).view(np.int64)
            rep = np.repeat(batch.column(0).to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(rep)], ["key", "rep"])


def _shingles(ngram: int):
    """(ref, e) of every distinct shingle of the texts."""

    def run(batches):
        for batch in batches:
            for block in blocks(batch.column(1), True):
                at, sets = zip(*row_sets(block, ngram), strict=True)
                rows = pa.array(np.repeat(at, [len(s) for s in sets]))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), pa.array(np.concatenate(sets).view(np.int64))], ["ref", "e"])

    return run


def _changes(ngram: int):
    """Per member its changes against the reference of its family, rare ones first, and how many are left from each on.

    ``e`` and ``n`` are the shingles that several of the family's sample have
    and in how many; those of more than half are the reference. Changes after
    which too few are left for any link are not written.
    """

    def run(batches):
        for batch in batches:
            ninths, size, change, remain = [], [], [], []
            seen, counts, sample = batch.column(4), batch.column(5), batch.column(6).to_numpy()
            texts = (s for block in blocks(batch.column(3), True) for _, s in row_sets(block, ngram))
            for i, s in enumerate(texts):
                common, n = seen[i].values.to_numpy().view(np.uint64), counts[i].values.to_numpy()
                order = np.argsort(common)
                common, n = common[order], n[order]
                usual = 2 * n > sample[i]
                lost = np.flatnonzero(usual & ~np.isin(common, s, assume_unique=True))
                added = np.setdiff1d(s, common[usual], assume_unique=True)
                at = np.minimum(np.searchsorted(common, added), max(len(common) - 1, 0))
                rate = np.where(common[at] == added, n[at], 0) if len(common) else np.zeros(len(added), np.int64)
                key = np.concatenate([added, mix(common[lost])])
                first = np.lexsort((key, np.concatenate([rate, sample[i] - n[lost]])))
                weight, after = 5 * len(lost) + 4 * len(added), np.arange(len(key), 0, -1)
                use = 9 * after > weight - int(usual.sum())
                ninths.append(weight)
                size.append(int(usual.sum()))
                change.append(key[first][use].view(np.int64))
                remain.append(after[use])
            if ninths:
                listed = [pa.array(x, pa.list_(pa.int64())) for x in (change, remain)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:3], pa.array(ninths, pa.int64()), pa.array(size, pa.int64()), *listed],
                    ["ref", "rep", "label", "ninths", "n_ref", "e", "left"],
                )

    return run


def estimate_passes(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Whether the collision-corrected register estimate allows a similarity of 0.8.

    Equal registers are corrected by the published expectation of accidental
    matches for sets of n and m elements; the bound lies five standard
    deviations of the estimate below 0.8.
    """
    either = ((x != EMPTY) | (y != EMPTY)).sum(1)
    hits = ((x == y) & (x != EMPTY)).sum(1)
    ratio = np.maximum(n, m) / np.maximum(np.minimum(n, m), 1)
    accidental = 0.169919487159739093975315012348 * REGISTERS / (1 << MANTISSA) * 4 * ratio / (1 + ratio) ** 2
    return hits - accidental >= 0.8 * either - 5 * np.sqrt(0.16 * np.maximum(either, 1))


def _estimate(batches):
    for batch in batches:
        if batch.num_rows:
            n, m = batch.column(2).to_numpy(), batch.column(4).to_numpy()
            ok = estimate_passes(_matrix(batch.column(3)), _matrix(batch.column(5)), n, m)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok)) for c in batch.columns[:2]], ["a", "b"])


def _confirm(ngram: int):
    def run(batches):
        for batch in batches:
            keep = []
            left = (s for block in blocks(batch.column(2), True) for _, s in row_sets(block, ngram))
            right = (s for block in blocks(batch.column(3), True) for _, s in row_sets(block, ngram))
            for s, t in zip(left, right, strict=True):
                both = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(both > 0 and 100 * both >= PERCENT * (len(s) + len(t) - both))
            ok = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([c.filter(ok) for c in batch.columns[:2]], ["a", "b"])

    return run


class _Search:
    """Links between the representatives (rep, n, regs, least: their row)."""

    def __init__(self, docs: DataFrame, reps: DataFrame, ngram: int):
        self.docs, self.reps, self.ngram = docs, reps, ngram

    def likely(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that pass the size filter and the register estimate."""
        side = lambda c, n, r: self.reps.select(F.col("rep").alias(c), F.col("n").alias(n), F.col("regs").alias(r))
        near = (
            pairs.distinct().join(side("b", "m", "t"), "b").join(side("a", "n", "s"), "a")
            .where(F.lit(100) * F.least("n", "m") >= F.lit(PERCENT) * F.greatest("n", "m"))
            .select("a", "b", "n", "s", "m", "t")
            .mapInArrow(_estimate, "a long, b long")
        )
        return store(near, "likely")

    def confirmed(self, likely: DataFrame) -> DataFrame:
        """Those of the pairs that are links, by their full sets."""
        one = self.texts.select(F.col("rep").alias("a"), F.col("text").alias("s"))
        two = self.texts.select(F.col("rep").alias("b"), F.col("text").alias("t"))
        found = likely.join(two, "b").join(one, "a").select("a", "b", "s", "t").mapInArrow(_confirm(self.ngram), "a long, b long")
        return store(found.distinct(), "confirmed")

    def groups(self) -> DataFrame:
        """(node, label) of the linked representatives."""
        rows = self.reps.select("rep", "regs").mapInArrow(_bands, "key long, rep long")
        buckets = store(
            rows.groupBy("key").agg(F.count("*").alias("size"), F.min("rep").alias("center")).where("size > 1"), "buckets"
        )
        members = store(rows.join(buckets, "key"), "members")
        stars = members.where("rep <> center").select(F.col("center").alias("a"), F.col("rep").alias("b"))
        likely = self.likely(stars)
        ids = likely.select("a").union(likely.select("b")).union(members.where("size > 2").select("rep")).distinct()
        rows_of = self.reps.join(ids.withColumnRenamed("a", "rep"), "rep", "left_semi").select("rep", *(F.col(f"least.{c}").alias(f"of_{c}") for c in ROW))
        same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in ROW]
        self.texts = store(self.docs.select(*_keys_of(self.docs), "text").join(rows_of, same).select("rep", "text").distinct(), "texts")
        edges = self.confirmed(likely)
        labels = components(edges)
        sized = labels.join(store(labels.groupBy("label").agg(F.count("*").alias("nodes")), "sizes"), "label")
        named = members.where("size > 2").join(sized, F.col("node") == F.col("rep"), "left")
        named = named.select("key", "rep", "size", "center", F.coalesce("label", "rep").alias("label"), F.coalesce("nodes", F.lit(1)).alias("nodes"))
        named = store(named, "named")
        # The label of the largest group is that of all buckets of a family of copies: one reference for them.
        largest = F.max_by("label", F.struct("nodes", -F.col("label"))).alias("ref")
        mixed = named.groupBy("key").agg(largest, F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
        mixed = store(mixed.select("key", "ref"), "mixed")
        left = store(named.join(mixed, "key").select("ref", "rep", "label").distinct(), "open")
        more = self.confirmed(self.likely(self._between(left)))
        return labels if more.isEmpty() else components(edges.unionByName(more))

    def _references(self, members: DataFrame) -> DataFrame:
        """(ref, e, n, sample): shingles that two or more of a family's sample of members have, and the sample's size."""
        order = Window.partitionBy("ref").orderBy(F.xxhash64("rep"), "rep")
        sample = store(members.withColumn("place", F.row_number().over(order)).where(F.col("place") <= TYPICAL).select("ref", "rep"), "sample")
        texts = sample.join(self.texts, "rep").select("ref", "text")
        counts = texts.mapInArrow(_shingles(self.ngram), "ref long, e long").groupBy("ref", "e").agg(F.count("*").alias("n")).where("n > 1")
        listed = counts.groupBy("ref").agg(F.collect_list(F.struct("e", "n")).alias("c"))
        sizes = sample.groupBy("ref").agg(F.count("*").alias("sample"))
        none = F.array().cast("array<long>")
        return sizes.join(listed, "ref", "left").select("ref", F.coalesce("c.e", none).alias("e"), F.coalesce("c.n", none).alias("n"), "sample")

    def _between(self, members: DataFrame) -> DataFrame:
        """Candidates between differing labels of every family (ref, rep, label)."""
        seen = store(self._references(members), "references")
        changed = store(
            members.join(self.texts, "rep").join(seen, "ref").select("ref", "rep", "label", "text", "e", "n", "sample")
            .mapInArrow(_changes(self.ngram), "ref long, rep long, label long, ninths long, n_ref long, e array<long>, left array<long>"),
            "changed",
        )
        least = F.min(F.struct("ninths", "rep", "label")).alias("c")
        placed = changed.join(store(changed.groupBy("ref").agg(least), "typical"), "ref")
        near = F.col("ninths") + F.col("c.ninths") <= F.col("n_ref")
        direct = placed.where(near & (F.col("label") != F.col("c.label"))).select(F.least("c.rep", "rep").alias("a"), F.greatest("c.rep", "rep").alias("b"))
        each = placed.select("ref", "rep", "label", "ninths", "n_ref", F.col("c.ninths").alias("base"), near.alias("near"), F.inline(F.arrays_zip("e", "left")))
        side = lambda d, x: d.select("ref", "e", *(F.col(c).alias(f"{x}_{c}") for c in ("rep", "label", "ninths", "n_ref", "left", "near")))
        x = side(each.where("not near and 9 * left >= ninths + base - n_ref"), "x")
        y = side(each.where("9 * left > ninths - base"), "y")
        # Were this their first common change, so many could still be shared; and so many must be.
        met = x.join(y, ["ref", "e"]).where(
            "x_label <> y_label and (y_near or x_rep < y_rep) and 9 * least(x_left, y_left) >= x_ninths + y_ninths - x_n_ref"
        )
        return met.select(F.least("x_rep", "y_rep").alias("a"), F.greatest("x_rep", "y_rep").alias("b")).unionByName(direct)


def _grouped(docs: DataFrame, ngram: int) -> tuple[DataFrame, DataFrame]:
    """The rows (ROW, n, d1, d2) and the sets (d1, d2, least); least is the first row of a set's group, null ids last."""
    sketch = store(
        docs.select(*_keys_of(docs), "text")
        .mapInArrow(_sketch(ngram), "doc_id long, text_digest long, row_digest long, n long, d1 long, d2 long, regs binary"),
        "sketch",
    )
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), *ROW)
    sets = sketch.where("n > 0").groupBy("d1", "d2").agg(F.min(row).alias("least"), F.first("n").alias("n"), F.first("regs").alias("regs"))
    sets = store(sets.withColumn("rep", F.monotonically_increasing_id()), "sets")
    labels = _Search(docs, sets, ngram).groups().withColumnRenamed("node", "rep")
    firsts = store(labels.join(sets.select("rep", "least"), "rep").groupBy("label").agg(F.min("least").alias("first")), "firsts")
    groups = sets.select("d1", "d2", "rep", "least").join(labels.join(firsts, "label").select("rep", "first"), "rep", "left")
    return sketch.drop("regs"), store(groups.select("d1", "d2", F.coalesce("first", "least").alias("least")), "groups")


def near_duplicates(docs: DataFrame, ngram: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``.

    component_id is the least doc_id of the texts reachable over links, the
    row's own included; kept holds where that is the row's own doc_id.
    """
    rows, groups = _grouped(docs, ngram)
    component = F.when(F.col("n") > 0, F.col("least.doc_id")).otherwise(F.col("doc_id"))
    out = rows.join(groups, ["d1", "d2"], "left").select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, ngram: int = 5) -> DataFrame:
    """The documents that stay: one row of every group, the first by doc_id (null ids last) and digests.

    Rows without words are in no group; of those equal in doc_id and text one stays.
    """
    rows, groups = _grouped(docs, ngram)
    empty = rows.where("n = 0").groupBy("doc_id", "text_digest").agg(F.min("row_digest").alias("row_digest"))
    kept = store(groups.select("least.*").select(*ROW).distinct().unionByName(empty), "kept")
    keyed = docs.select(F.struct(*(quoted(c) for c in docs.columns)).alias("row"), F.struct(*_keys_of(docs)).alias("keys"))
    same = [F.col(f"keys.{c}").eqNullSafe(kept[c]) for c in ROW]
    return keyed.join(kept, same, "left_semi").dropDuplicates(["keys"]).select("row.*")
