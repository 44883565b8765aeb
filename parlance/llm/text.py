"""Vectorized word and shingle hashing of Arrow text columns (runs inside tasks).

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D; as those are
ASCII, working on UTF-8 bytes gives the same words as working on characters.
A word's hash is the polynomial sum of a random 64-bit value per byte, so
whole batches are hashed with a few numpy passes and lower-casing is only
another value table. Texts are never cut: a batch is walked in blocks of whole
rows, and a row longer than a block is hashed in segments whose sums add up.
Equality of two words or shingles means equality of their 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x = x * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def _byte_values(lower: bool) -> np.ndarray:
    v = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    if lower:
        v[0x41:0x5B] = v[0x61:0x7B]
    v[SPACE] = 0
    return v


VALUES = {True: _byte_values(True), False: _byte_values(False)}


def powers(n: int, base: int = BASE) -> np.ndarray:
    p = np.full(n, base & MASK, np.uint64)
    p[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(p, dtype=np.uint64)


_POWERS: dict = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n not in _POWERS:
        _POWERS[n] = powers(n), powers(n, pow(BASE, -1, 1 << 64))
    return _POWERS[n]


class Block:
    """Rows ``lo`` to ``hi`` of a column: bytes, row offsets, words and their hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lo: int, lower: bool):
        self.lo, self.n = lo, len(offsets) - 1
        self.data, self.offsets = data, offsets
        solid = ~SPACE[data]
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        begins = offsets[:-1][offsets[:-1] < offsets[1:]]
        first[begins] = solid[begins]
        self.solid = solid
        self.starts = np.flatnonzero(first)
        self.hashes = self._hash(lower)
        #: Words of row i are word_at[i] to word_at[i + 1].
        self.word_at = np.searchsorted(self.starts, offsets)

    def _hash(self, lower: bool) -> np.ndarray:
        data, starts = self.data, self.starts
        out = np.zeros(len(starts), np.uint64)
        if not len(starts):
            return out
        up, down = _tables(BLOCK)
        with np.errstate(over="ignore"):
            for at in range(0, len(data), BLOCK):
                part = data[at : at + BLOCK]
                i, j = np.searchsorted(starts, (at, at + len(part)))
                sums = VALUES[lower][part]
                sums *= up[: len(part)]
                cut = starts[i:j] - at
                if i and (j == i or cut[0] > 0):  # the word before reaches into this segment, or white space
                    head = sums[: cut[0]] if j > i else sums
                    out[i - 1] += np.add.reduce(head) * np.uint64(pow(BASE, int(at - starts[i - 1]), 1 << 64))
                if j > i:
                    out[i:j] += np.add.reduceat(sums, cut) * down[cut]
        return mix(out)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all k-word windows in order, and the row offsets into them.

        A row with fewer than k words, but at least one, has its whole word
        sequence as its single shingle; a row without words has none.
        """
        h, w = self.hashes, self.word_at
        count = np.diff(w)
        sizes = np.where(count >= k, count - k + 1, np.minimum(count, 1))
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        total = int(offsets[-1])
        at = np.arange(total) - np.repeat(offsets[:-1], sizes) + np.repeat(w[:-1], sizes)
        end = np.repeat(w[1:], sizes)
        out = np.repeat(np.minimum(count, k), sizes).astype(np.uint64)
        with np.errstate(over="ignore"):
            for j in range(k):
                ok = at + j < end
                weight = np.uint64(pow(0x2545F4914F6CDD1D, j + 1, 1 << 64))
                out += np.where(ok, h[np.minimum(at + j, len(h) - 1)] * weight, np.uint64(0)) if total else out
        return mix(out), offsets


def blocks(column: pa.Array, lower: bool):
    """The column as Blocks of whole rows, about BLOCK bytes each; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + BLOCK, "right")) - 1)
        yield Block(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], lo, lower)
        lo = hi


def row_sets(block: Block, k: int):
    """(row number, sorted distinct k-word shingles) of every row of the block."""
    h, at = block.shingles(k)
    for i in range(block.n):
        s = np.sort(h[at[i] : at[i + 1]])
        if len(s) > 1:
            s = s[np.concatenate([[True], s[1:] != s[:-1]])]
        yield block.lo + i, s
