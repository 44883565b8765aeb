"""Document quality by attention over passages (operator 6).

A document is a bag of passages of PASSAGE words. Every passage is encoded from
its own text (its words by hash into HASHED buckets, shares of character
classes, repetition, word lengths) through a learned layer, a gated
attention network weighs the passages, and the weighted passage representation
is scored. Only document labels are learned from:

    e_k = tanh(E x_k);  a = softmax_k w . (tanh(V e_k) * sigmoid(U e_k));
    score = sigmoid(c . sum_k a_k e_k + b)

Training takes at most SAMPLE labelled documents of each class, of those that
are in the table and have a word those whose hashed id is least, whole; at most that many rows ever reach the driver: of the
texts of one doc_id, the one whose features come first. Scoring is one pass over
all documents without a shuffle.

Rows: a text without words (null too) has no passage and scores EMPTY_SCORE;
repeated rows score alike; labels that are null or not 0 or 1 are not used, and
a document labelled both ways is left out of training. Without such documents of both
classes every text with words scores the share of label 1 (0.5 without any).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import WORD, store
from parlance.llm.text import blocks

PASSAGE = 64
SAMPLE = 1500
STEPS = 150
HIDDEN = 16
EMPTY_SCORE = 0.0
THRESHOLD = 0.7


def _classes() -> np.ndarray:
    c = np.full(256, 8, np.uint8)  # other punctuation and control characters
    c[0x61:0x7B] = 0
    c[0x41:0x5B] = 1
    c[0x30:0x3A] = 2
    c[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = 3
    c[0x0A] = 4
    c[ord("|")] = 5
    c[ord("!")] = 6
    c[list(b"#*$%&<>")] = 7
    c[list(b".,;:?")] = 9
    c[0x80:0xC0] = 10
    c[0xC0:] = 11
    return c


CLASSES = _classes()
HASHED = 64
N_FEATURES = 12 + 6 + HASHED


def passages(block) -> tuple[np.ndarray, np.ndarray]:
    """Features of the block's passages in order, and the row offsets into them."""
    words = np.diff(block.word_at)
    per_row = -(-words // PASSAGE)
    at = np.concatenate([[0], np.cumsum(per_row)])
    n = int(at[-1])
    if not n:
        return np.zeros((0, N_FEATURES)), at
    first = np.repeat(block.word_at[:-1], per_row) + PASSAGE * (np.arange(n) - np.repeat(at[:-1], per_row))
    begin = block.starts[first]
    end = np.append(begin[1:], len(block.data))
    last = at[1:][per_row > 0] - 1  # the last passage of a row ends with the row
    end[last] = block.offsets[1:][per_row > 0]
    size = np.maximum(end - begin, 1)
    marks = np.zeros(len(block.data) + 1, np.int64)
    np.add.at(marks, begin, 1)
    of_byte = np.cumsum(marks[:-1]) - 1
    inside = of_byte >= 0
    counts = np.bincount(of_byte[inside] * 12 + CLASSES[block.data][inside], minlength=12 * n).reshape(n, 12)
    # Leading white space of the next row counts with the passage before it: take it out.
    stray = np.zeros(n, np.int64)
    stray[:-1] = begin[1:] - end[:-1]
    stray[-1] = len(block.data) - end[-1]
    counts[:, 3] = np.maximum(counts[:, 3] - stray, 0)
    n_in = np.append(first[1:], len(block.hashes)) - first
    of_word = np.repeat(np.arange(n), n_in)
    h = block.hashes
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (of_word[1:] == of_word[:-1])
    key = np.sort((of_word.astype(np.uint64) << np.uint64(40)) | (h >> np.uint64(24)))
    new = np.concatenate([[True], key[1:] != key[:-1]])
    distinct = np.bincount((key[new] >> np.uint64(40)).astype(np.int64), minlength=n)
    upper = np.bincount(of_word, (CLASSES[block.data[block.starts]] == 1), n)
    shares = counts / size[:, None]
    letters = counts[:, [0, 1, 10, 11]].sum(1) + 1
    extra = np.stack(
        [
            np.bincount(of_word, same, n) / n_in,
            distinct / n_in,
            upper / n_in,
            np.log1p((size - counts[:, 3] - counts[:, 4]) / n_in),
            counts[:, 1] / letters,
            np.log1p(n_in) / np.log1p(PASSAGE),
        ],
        axis=1,
    )
    # The words' hashes are well mixed, so their top bits serve as the bucket.
    bucket = (h >> np.uint64(64 - HASHED.bit_length() + 1)).astype(np.int64)
    hashed = np.bincount(of_word * HASHED + bucket, minlength=n * HASHED).reshape(n, HASHED) / n_in[:, None]
    return np.concatenate([shares, extra, hashed], 1), at


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model:
    """Weights of the network; ``score`` and ``fit`` take passage features and row offsets."""

    def __init__(self, constant: float | None = None):
        self.constant = constant

    def _forward(self, x, at):
        rows = np.repeat(np.arange(len(at) - 1), np.diff(at))
        e = np.tanh((x - self.mean) / self.std @ self.p["E"])
        v, u = np.tanh(e @ self.p["V"]), sigmoid(e @ self.p["U"])
        s = (v * u) @ self.p["w"]
        top = np.maximum.reduceat(s, at[:-1])
        a = np.exp(s - top[rows])
        a /= np.add.reduceat(a, at[:-1])[rows]
        z = np.add.reduceat(a[:, None] * e, at[:-1], axis=0)
        return rows, e, v, u, a, z, sigmoid(z @ self.p["c"] + self.p["b"])

    def score(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Scores of the rows; those without a passage get EMPTY_SCORE."""
        out = np.full(len(at) - 1, EMPTY_SCORE)
        some = np.diff(at) > 0
        if some.any():
            out[some] = self.constant if self.constant is not None else self._forward(x, np.append(at[:-1][some], at[-1]))[-1]
        return out

    def fit(self, x: np.ndarray, at: np.ndarray, y: np.ndarray, seed: int = 7) -> Model:
        """Full-batch Adam on the logistic loss; every row has a passage."""
        rng = np.random.default_rng(seed)
        self.mean, self.std = x.mean(0), x.std(0) + 1e-3
        d = x.shape[1]
        self.p = {
            "E": rng.normal(0, d**-0.5, (d, HIDDEN)), "V": rng.normal(0, HIDDEN**-0.5, (HIDDEN, HIDDEN)),
            "U": rng.normal(0, HIDDEN**-0.5, (HIDDEN, HIDDEN)), "w": rng.normal(0, 0.1, HIDDEN),
            "c": rng.normal(0, 0.1, HIDDEN), "b": np.zeros(1),
        }
        m = {k: np.zeros_like(q) for k, q in self.p.items()}
        r = {k: np.zeros_like(q) for k, q in self.p.items()}
        scaled = (x - self.mean) / self.std
        for step in range(1, STEPS + 1):
            rows, e, v, u, a, z, o = self._forward(x, at)
            do = (o - y) / len(y)
            dz = do[:, None] * self.p["c"]
            da = (dz[rows] * e).sum(1)
            ds = a * (da - np.add.reduceat(a * da, at[:-1])[rows])
            dv = ds[:, None] * self.p["w"] * u * (1 - v * v)
            du = ds[:, None] * self.p["w"] * v * u * (1 - u)
            de = a[:, None] * dz[rows] + dv @ self.p["V"].T + du @ self.p["U"].T
            g = {
                "E": scaled.T @ (de * (1 - e * e)), "V": e.T @ dv, "U": e.T @ du, "w": (v * u).T @ ds,
                "c": z.T @ do, "b": np.array([do.sum()]),
            }
            for k in self.p:
                g[k] = g[k] + 1e-4 * self.p[k]
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                r[k] = 0.99 * r[k] + 0.01 * g[k] ** 2
                self.p[k] = self.p[k] - 0.03 * (m[k] / (1 - 0.9**step)) / (np.sqrt(r[k] / (1 - 0.99**step)) + 1e-8)
        return self


def _features(batches):
    for batch in batches:
        out = []
        for block in blocks(batch.column(2), False):
            x, at = passages(block)
            out += [x[at[i] : at[i + 1]].astype("<f4").tobytes() for i in range(block.n)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(out, pa.binary())], ["doc_id", "y", "x"])


def held_out(doc_id="doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on the first ``sample`` documents of each class by hashed id, held-out ids left out."""
    marked = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.min("quality").alias("y"), F.max("quality").alias("z"))
        .where("y = z").select("doc_id", "y")
    )
    # Labels may cover other documents too: only those that can be read count, for the sample and the share.
    present = docs.where(F.col("text").rlike(WORD)).select("doc_id").distinct()
    marked = store(marked.join(present, "doc_id", "left_semi"), "marked")
    share = marked.agg(F.avg("y")).first()[0]
    if share in (None, 0.0, 1.0):
        return Model(0.5 if share is None else float(share))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = marked.where("y = 0").orderBy(*order).limit(sample).union(marked.where("y = 1").orderBy(*order).limit(sample))
    # At most 2 * sample ids: bounded, so a broadcast keeps the texts from being shuffled.
    rows = (
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "y", "text")
        .mapInArrow(_features, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, y int, x binary")
        .where("length(x) > 0").groupBy("doc_id", "y").agg(F.min("x").alias("x")).toArrow()
    )
    rows = rows.sort_by("doc_id")
    parts = [np.frombuffer(b, "<f4").reshape(-1, N_FEATURES).astype(float) for b in rows.column("x").to_pylist()]
    y = np.array(rows.column("y").to_pylist(), float)
    if not len(y) or y.min() == y.max():
        return Model(float(share))
    return Model().fit(np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])]), y)


def _score(model: Model, at: int, keep: float | None):
    def run(batches):
        for batch in batches:
            scores = [model.score(*passages(block)) for block in blocks(batch.column(at), False)]
            s = np.concatenate(scores) if scores else np.zeros(0)
            if keep is None:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s)], ["doc_id", "score"])
            else:
                yield batch.filter(pa.array(s >= keep))

    return run


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score), one row per document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_score(model, 1, None), f"doc_id {kind}, score double")


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score ``threshold`` or more, all columns as they are."""
    return docs.mapInArrow(_score(model, docs.columns.index("text"), threshold), docs.schema)
