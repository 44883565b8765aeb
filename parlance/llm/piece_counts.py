"""Token counts by a linear longest-match automaton (operator 4).

A word is cut greedily into the longest pieces of a vocabulary. The trie of all
pieces carries, at every node, a failure link and the number of pieces popped
on the way: when the next byte has no edge, the pieces that are then certain
are counted and matching goes on at the linked node, so a word is read once,
byte by byte, whatever the pieces are, and no piece is ever built.

The vocabulary is a public byte-level one; a word is preceded by one blank, as
its word-initial pieces are. A byte without a piece of its own counts as one
unknown piece. Counts of words already met are kept per task, up to a bound.

Rows: a text without words (null too) has no words and no tokens; repeated
rows count each; extra columns are not read.
"""

from __future__ import annotations

from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame

from parlance.llm.packing import VOCABULARY, read_vocabulary
from parlance.llm.text import blocks

REMEMBERED = 300_000


def automaton(pieces) -> tuple[dict[int, int], list[int], list[int]]:
    """(edges, link, popped): edges by node * 256 + byte; node 0 is the root.

    ``link[v]`` is the node of what remains of v's string after ``popped[v]``
    pieces are cut off it. Every byte has an edge from the root.
    """
    edges: dict[int, int] = {}
    parent, byte, whole = [0], [0], [True]
    for piece in sorted({bytes([b]) for b in range(256)} | {p for p in pieces if p}):
        node = 0
        for b in piece:
            edge = node << 8 | b
            if edge not in edges:
                edges[edge] = len(parent)
                parent.append(node)
                byte.append(b)
                whole.append(False)
            node = edges[edge]
        whole[node] = True
    below: list[list[int]] = [[] for _ in parent]
    for node in range(1, len(parent)):
        below[parent[node]].append(node)
    link, popped = [0] * len(parent), [0] * len(parent)
    queue = deque(below[0])
    while queue:
        node = queue.popleft()
        queue.extend(below[node])
        if whole[node]:
            popped[node] = 1  # the whole string is one piece; nothing remains
            continue
        at, n = link[parent[node]], popped[parent[node]]
        while at << 8 | byte[node] not in edges:
            n += popped[at]
            at = link[at]
        link[node], popped[node] = edges[at << 8 | byte[node]], n
    return edges, link, popped


class Counter(dict):
    """Word -> number of pieces; words not met before are run through the automaton."""

    def __init__(self, edges, link, popped):
        self.edges, self.link, self.popped = edges, link, popped

    def __missing__(self, word: bytes) -> int:
        edges, link, popped = self.edges, self.link, self.popped
        node = n = 0
        for b in b" " + word:
            step = edges.get(node << 8 | b)
            while step is None:
                n += popped[node]
                node = link[node]
                step = edges.get(node << 8 | b)
            node = step
        while node:
            n += popped[node]
            node = link[node]
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = n
        return n


def _count(sent):
    def run(batches):
        counts = Counter(*sent.value)
        for batch in batches:
            words, tokens = [], []
            for block in blocks(batch.column(1), False):
                raw, o = block.data.tobytes(), block.offsets
                for i in range(block.n):
                    found = raw[o[i] : o[i + 1]].split()
                    words.append(len(found))
                    tokens.append(sum(map(counts.__getitem__, found)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], ["doc_id", "n_words", "n_tokens"])

    return run


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_words, n_tokens), one row per document; the automaton's size is the vocabulary's."""
    sent = docs.sparkSession.sparkContext.broadcast(automaton(read_vocabulary(vocabulary)))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_count(sent), f"doc_id {kind}, n_words long, n_tokens long")
