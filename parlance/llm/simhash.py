"""SimHash near-duplicates by the general pigeonhole principle (operator 13).

A fingerprint has bit j set if it is set in over half of the text's shingle
hashes (XXH64 of the lower-cased, space-joined 3-word shingles, repeats
included; fewer words: the whole sequence; no word: zero). Texts are linked
when their fingerprints differ in at most RADIUS bits.

1. Equal fingerprints are one node, so a group of copies costs one row.
2. Bits are grouped into partitions so that correlated ones share a partition
   (correlations of a bounded sample of fingerprints, in hash order).
3. A partition i may be searched for up to t(i) differing bits; with
   t(i) + 1 >= 0 summing to RADIUS + 1 no pair within RADIUS differs by more
   than t(i) everywhere. Each fingerprint gets its own thresholds by dynamic
   programming over the partitions: the cost of a threshold is the rows that it
   probes plus the candidates that the sample predicts. The number of
   partitions is that of the least predicted cost, so probes widen with the data.
4. Every fingerprint is stored once per partition and probes with all
   variants of its bits there within t(i); the join keeps pairs of at most
   RADIUS differing bits. Distinct fingerprints within 3 bits of one are at most
   43,744, so links grow with the fingerprints, not with their square.

The sample steers cost only; links are exact whatever it holds. Rows: a null or
empty text has fingerprint zero, linked like any other; repeated rows stay, each
with its row; a component with null ids only has a null component_id; doc_id is
an integer; other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import store
from parlance.llm.graph import components

BITS = 64
RADIUS = 3
NGRAM = 3
SEED = 42
#: Fingerprints from which correlations are taken, and of these those that predict candidates: bounds on what the driver holds.
SAMPLE = 16_384
PREDICT = 1_024
PARTITIONS = (2, 3, 4)
#: What a probed row costs, in compared candidates: it is shuffled and sorted.
PROBE = 4.0
#: Shingles whose bits are counted at once.
STEP = 1 << 15
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: bytes | None) -> int:
    """The SimHash of a UTF-8 text; its words are split at ASCII white space."""
    words = (text or b"").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    span = min(NGRAM, len(words))
    begins, ends = (end - size)[: len(words) - span + 1].tolist(), end[span - 1 :].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(begins), STEP):
        h = [digest(joined[i:j], SEED) for i, j in zip(begins[at : at + STEP], ends[at : at + STEP], strict=True)]
        bits = np.unpackbits(np.array(h, "<u8").view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, BITS).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(begins), bitorder="little").view("<u8")[0])


def _fingerprints(batches):
    for batch in batches:
        found = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else None) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], ["doc_id", "fp"])


def partitions(sample: np.ndarray, m: int) -> list[list[int]]:
    """The bits in m groups of nearly equal width, each grown from its most correlated pair by the bit most correlated with it."""
    bits = ((sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float64)
    bits -= bits.mean(0)
    scale = np.sqrt((bits**2).sum(0))
    alike = np.abs(bits.T @ bits) / np.maximum(np.outer(scale, scale), 1e-9)
    np.fill_diagonal(alike, 0)
    free, groups = list(range(BITS)), []
    for i in range(m):
        width = BITS // m + (i < BITS % m)
        if len(free) == width:
            groups.append(free)
            break
        among = alike[np.ix_(free, free)]
        group = [free[j] for j in np.unravel_index(among.argmax(), among.shape)]
        while len(group) < width:
            rest = [b for b in free if b not in group]
            group.append(rest[int(alike[np.ix_(rest, group)].sum(1).argmax())])
        groups.append(sorted(group))
        free = [b for b in free if b not in group]
    return groups


class Plan:
    """Partitions of the bits and what predicts the candidates of a threshold."""

    def __init__(self, sample: np.ndarray, n: int, m: int):
        self.groups = partitions(sample, m)
        self.masks = [np.uint64(sum(1 << b for b in g)) for g in self.groups]
        self.sample, self.scale = sample[:PREDICT], n / max(len(sample[:PREDICT]), 1)

    def flips(self, i: int, units: int) -> np.ndarray:
        """What to flip in partition i for all variants of fewer than ``units`` differing bits."""
        out = [sum(1 << b for b in c) for t in range(units) for c in combinations(self.groups[i], t)]
        return np.array(out, np.uint64)

    def allocate(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(units, cost): per query the units t + 1 of every partition, summing to RADIUS + 1 at the least predicted cost."""
        width = RADIUS + 2
        best = np.full((len(queries), width), np.inf)
        best[:, 0] = 0
        chosen = []
        for i, mask in enumerate(self.masks):
            apart = np.bitwise_count((queries[:, None] ^ self.sample) & mask)
            cost = np.zeros((len(queries), width))
            for k in range(1, width):
                cost[:, k] = PROBE * len(self.flips(i, k)) + self.scale * (apart < k).sum(1)
            options = np.full((width, len(queries), width), np.inf)
            for k in range(width):
                options[k, :, k:] = best[:, : width - k] + cost[:, k : k + 1]
            chosen.append(options.argmin(0))
            best = options.min(0)
        units = np.zeros((len(queries), len(self.masks)), np.int64)
        left, rows = np.full(len(queries), width - 1), np.arange(len(queries))
        for i in range(len(self.masks) - 1, -1, -1):
            units[:, i] = chosen[i][rows, left]
            left = left - units[:, i]
        return units, best[:, -1]

    @staticmethod
    def cheapest(sample: np.ndarray, n: int) -> Plan:
        plans = [Plan(sample, n, m) for m in PARTITIONS]
        return min(plans, key=lambda p: p.allocate(p.sample)[1].mean() + PROBE * len(p.masks))


def _stored(masks: list):
    """(part, sig, fp): the bits of every fingerprint in every partition."""

    def run(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            for i, mask in enumerate(masks):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fp), i, np.int32)), pa.array((fp & mask).view(np.int64)), batch.column(0)], ["part", "sig", "fp"])

    return run


def _probes(plan: Plan):
    """(part, sig, q): the variants that every fingerprint has to look up."""

    def run(batches):
        flips = {}
        for batch in batches:
            q = batch.column(0).to_numpy().view(np.uint64)
            units, _ = plan.allocate(q)
            for i, mask in enumerate(plan.masks):
                for k in np.unique(units[:, i][units[:, i] > 0]).tolist():
                    if (i, k) not in flips:
                        flips[i, k] = plan.flips(i, k)
                    own = q[units[:, i] == k]
                    sig = ((own & mask)[:, None] ^ flips[i, k]).ravel()
                    sent = np.repeat(own, len(flips[i, k]))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(sig), i, np.int32)), pa.array(sig.view(np.int64)), pa.array(sent.view(np.int64))], ["part", "sig", "q"])

    return run


def links(prints: DataFrame) -> DataFrame:
    """(a, b), a < b: all pairs of distinct fingerprints (fp) that differ in at most RADIUS bits."""
    n = prints.count()
    if n < 2:
        return prints.sparkSession.createDataFrame([], "a long, b long")
    drawn = prints.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()
    plan = Plan.cheapest(np.array([r.fp for r in drawn], np.int64).view(np.uint64), n)
    index = prints.select("fp").mapInArrow(_stored(plan.masks), "part int, sig long, fp long")
    probes = prints.select("fp").mapInArrow(_probes(plan), "part int, sig long, q long")
    near = F.bit_count(F.col("q").bitwiseXOR(F.col("fp"))) <= RADIUS
    # Both of a pair look the other up, so one direction is enough.
    found = probes.join(index, ["part", "sig"]).where(near & (F.col("q") < F.col("fp")))
    return found.select(F.col("q").alias("a"), F.col("fp").alias("b")).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``.

    component_id is the least doc_id reachable over links, the row's own included.
    """
    rows = store(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_fingerprints, "doc_id long, fp long"), "fingerprints")
    prints = store(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    labels = components(store(links(prints), "near"))
    own = labels.join(prints, F.col("node") == F.col("fp"))
    firsts = store(own.groupBy("label").agg(F.min("least").alias("first")), "firsts")
    linked = labels.join(firsts, "label").select(F.col("node").alias("fp"), "first")
    groups = store(prints.join(linked, "fp", "left").select("fp", F.coalesce("first", "least").alias("component_id")), "groups")
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(groups, "fp").select("doc_id", shown.alias("fingerprint"), "component_id")
