"""Token-id output: best-fit-decreasing packing into fixed-length rows (operator 2).

Texts are encoded with a public byte-level vocabulary and closed by an end id.
Documents are dealt by hash to shards of about SHARD_BYTES of text, the copies of
a repeated row each by a number of its own; within a
shard, documents longer than a row are split losslessly into segments, and the
segments, longest first, go to the open row with the least room that fits, found
by a segment tree over the row capacities. Shards do not depend on partitions,
so reruns and retried tasks give the same rows.

A row holds its ids and position ids as little-endian matrices of ``length``
entries (positions restart at 0 with every segment, padding has position 0),
the cumulative segment lengths, and for every segment its document and the
offset of its first token in that document, so documents can be put together
again.

Rows: a null or empty text has no tokens and no segment; repeated rows are
packed each; null doc_ids are carried; extra columns are not read. An empty
table gives an empty result.
"""

from __future__ import annotations

import base64
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import store

LENGTH = 2048
SHARD_BYTES = 4 << 20
VOCABULARY = os.environ.get("PARLANCE_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: Fixed value: the pre-tokenization pattern of the byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def read_vocabulary(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class CapacityTree:
    """Least non-empty capacity that is at least a given one, in a tree over 0..length."""

    def __init__(self, length: int):
        self.leaves = 1 << length.bit_length()
        self.some = bytearray(2 * self.leaves)
        self.rows: dict[int, list[int]] = {}

    def add(self, capacity: int, row: int) -> None:
        held = self.rows.setdefault(capacity, [])
        held.append(row)
        if len(held) == 1:
            node = capacity + self.leaves
            while node and not self.some[node]:
                self.some[node] = 1
                node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(capacity, row) of the best fit, removed from the tree."""
        node = need + self.leaves
        if not self.some[node]:
            while node & 1 or not self.some[node + 1]:  # up to a left child whose sibling holds something
                node >>= 1
                if node <= 1:
                    return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.some[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        held = self.rows[capacity]
        row = held.pop()
        if not held:
            self.some[node] = 0
            node >>= 1
            while node and not (self.some[2 * node] or self.some[2 * node + 1]):
                self.some[node] = 0
                node >>= 1
        return capacity, row


def best_fit_decreasing(lengths: np.ndarray, length: int) -> list[list[int]]:
    """Rows of segment numbers; longest segment first, ties in the order given."""
    tree, rows = CapacityTree(length), []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        found = tree.take(n) if n < length else None
        if found is None:
            rows.append([i])
            room, row = length - n, len(rows) - 1
        else:
            rows[found[1]].append(i)
            room, row = found[0] - n, found[1]
        if room:
            tree.add(room, row)
    return rows


def _encoder(sent):
    """The encoder of this worker process, kept with the broadcast value."""
    held = sent.value
    if "encoder" not in held:
        import tiktoken

        held["encoder"] = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=held["ranks"], special_tokens={})
    return held["encoder"]


def _pack(sent, length: int):
    def run(table: pa.Table) -> pa.Table:
        encoder, end = _encoder(sent), sent.value["end"]
        kind = "<u2" if end < 1 << 16 else "<u4"
        table = table.take(pa.compute.sort_indices(table, [("doc_id", "ascending"), ("text", "ascending")]))
        ids, doc, offset = [], [], []
        for row, text in enumerate(table.column("text")):
            text = text.as_py()
            if text:
                tokens = np.append(np.array(encoder.encode_ordinary(text), kind), np.array([end], kind))
                for at in range(0, len(tokens), length):
                    ids.append(tokens[at : at + length])
                    doc.append(row)
                    offset.append(at)
        lengths = np.array([len(x) for x in ids], np.int64)
        out = {k: [] for k in ("pack", "n_tokens", "input_ids", "position_ids", "cu_seqlens", "segment_docs", "segment_offsets")}
        doc_ids = table.column("doc_id").to_pylist()
        ramp = np.arange(length, dtype="<u4" if length > 1 << 16 else "<u2")
        for number, segments in enumerate(best_fit_decreasing(lengths, length)):
            ends = np.cumsum(lengths[segments])
            matrix, position = np.full(length, end, kind), np.zeros(length, ramp.dtype)
            for i, stop in zip(segments, ends, strict=True):
                matrix[stop - lengths[i] : stop] = ids[i]
                position[stop - lengths[i] : stop] = ramp[: lengths[i]]
            out["pack"].append(number)
            out["n_tokens"].append(int(ends[-1]))
            out["input_ids"].append(matrix.tobytes())
            out["position_ids"].append(position.tobytes())
            out["cu_seqlens"].append([0, *ends.tolist()])
            out["segment_docs"].append([doc_ids[doc[i]] for i in segments])
            out["segment_offsets"].append([offset[i] for i in segments])
        shard = table.column("shard")[0]
        return pa.Table.from_arrays(
            [
                pa.array([shard.as_py()] * len(out["pack"]), pa.int64()), pa.array(out["pack"], pa.int64()),
                pa.array(out["n_tokens"], pa.int64()), pa.array(out["input_ids"], pa.binary()),
                pa.array(out["position_ids"], pa.binary()), pa.array(out["cu_seqlens"], pa.list_(pa.int32())),
                pa.array(out["segment_docs"], pa.list_(table.schema.field("doc_id").type)),
                pa.array(out["segment_offsets"], pa.list_(pa.int64())),
            ],
            ["shard", *out],
        )

    return run


def numbered_copies(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, text) with a ``copy`` that numbers equal rows, so that they can be dealt apart.

    Keys met more than once are found on hashes; only their rows are grouped (with
    partial counts) and spread again. The others go on without a shuffle of their own
    where those keys are few.
    """
    keyed = rows.withColumn("pack_key", F.xxhash64("doc_id", "text"))
    repeated = store(keyed.groupBy("pack_key").count().where("count > 1").select("pack_key"), "repeated")
    once = keyed.join(repeated, "pack_key", "left_anti").withColumn("copy", F.lit(1).cast("long"))
    more = keyed.join(repeated, "pack_key", "left_semi").groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("n"))
    more = more.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    return once.select("doc_id", "text", "copy").unionByName(more.select("doc_id", "text", "copy"))


def pack(docs: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Packed rows: shard, pack, n_tokens, input_ids, position_ids, cu_seqlens, segment_docs, segment_offsets.

    The vocabulary is read by the driver and sent to the tasks: its size does
    not depend on the data. Ids of fewer than 65,536 are written in two bytes.
    """
    spark = docs.sparkSession
    ranks = read_vocabulary(vocabulary)
    sent = spark.sparkContext.broadcast({"ranks": ranks, "end": max(ranks.values()) + 1})
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return (
        numbered_copies(docs.select("doc_id", "text").where("text <> ''"))
        .select("doc_id", "text", F.pmod(F.xxhash64("doc_id", "text", "copy"), F.lit(shards)).alias("shard"))
        .groupBy("shard")
        .applyInArrow(
            _pack(sent, length),
            "shard long, pack long, n_tokens long, input_ids binary, position_ids binary, cu_seqlens array<int>, "
            f"segment_docs array<{kind}>, segment_offsets array<long>",
        )
    )
