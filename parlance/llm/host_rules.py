"""Quality rules judged by document and by host (operator 5).

Every whole text gets its base measures and rule verdict. Failures are then
summed per host; a host's failure rate is shrunk towards the rate of all hosts
by a beta prior fitted to the hosts' rates (method of moments), so a host of a
few documents is not condemned by one of them. Documents of a host whose shrunk
rate is above ``max_rate`` are not kept.

Rows: a null or blank text has no words and fails; a null host is a host of its
own; repeated rows count as often as they occur; columns other than id, text
and host are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import store
from parlance.llm.text import blocks

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_RATE = 0.5
#: Prior weight, in documents, beyond which all hosts count as alike.
MAX_STRENGTH = 1e9
BLANK = b" \t\n\r\x0b\x0c"

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1
_POINT = np.ones(256, np.int64)  # bytes that begin a code point
_POINT[0x80:0xC0] = 0


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


def repeat_words(h: np.ndarray) -> int:
    """Words inside a window of three whose hash occurs twice or more in ``h``, the windows in order."""
    s = np.sort(h)
    twice = s[1:][s[1:] == s[:-1]]
    if not len(twice):
        return 0
    hit = np.isin(h, twice)
    covered = np.zeros(len(h) + 2, bool)
    for j in range(3):
        covered[j : j + len(h)] |= hit
    return int(covered.sum())


def dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip(BLANK)]
    return len(lines) - len(set(lines))


def _measure(batches):
    for batch in batches:
        cols = [[] for _ in range(5)]
        for block in blocks(batch.column(1), False):
            windows, at = block.shingles(3)
            words = np.diff(block.word_at)
            cols[0].append(words)
            cols[1].append(_sums(_POINT[block.data] * block.solid, block.offsets))
            cols[2].append(_sums(_SYMBOL[block.data], block.offsets))
            raw, o = block.data.tobytes(), block.offsets
            cols[3].append(np.array([dup_lines(raw[o[i] : o[i + 1]]) for i in range(block.n)], np.int64))
            cols[4].append(np.array([repeat_words(windows[at[i] : at[i + 1]]) for i in range(block.n)], np.int64))
        if batch.num_rows:
            arrays = [pa.array(np.concatenate(c), pa.int64()) for c in cols]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *arrays], ["doc_id", "host", *MEASURES])


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def host_verdicts(measured: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """(host, host_docs, host_failures, host_rate, host_ok) from rows of (host, base_failed)."""
    hosts = store(
        measured.groupBy("host").agg(
            F.count("*").alias("host_docs"), F.sum(F.col("base_failed").cast("long")).alias("host_failures")
        ),
        "hosts",
    )
    rate = F.col("host_failures") / F.col("host_docs")
    prior = hosts.agg(F.avg(rate).alias("m"), F.var_pop(rate).alias("v")).first()  # one row
    m, v = prior["m"] or 0.0, prior["v"] or 0.0
    strength = min(max(m * (1 - m) / v - 1, 0.0), MAX_STRENGTH) if v > 0 else MAX_STRENGTH
    shrunk = (F.col("host_failures") + F.lit(m * strength)) / (F.col("host_docs") + F.lit(strength))
    return hosts.withColumn("host_rate", shrunk).withColumn("host_ok", F.col("host_rate") <= F.lit(max_rate))


def judge(docs: DataFrame, host: str = "source", max_rate: float = MAX_RATE) -> DataFrame:
    """One row per row of ``docs``: measures, base_failed, its host's rate, kept."""
    fields = ", ".join(f"{c} long" for c in MEASURES)
    measured = (
        docs.select("doc_id", "text", F.col(host).cast("string").alias("host"))
        .mapInArrow(_measure, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, host string, {fields}")
        .withColumn(
            "base_failed",
            (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        )
    )
    measured = store(measured, "measured")
    verdicts = store(host_verdicts(measured, max_rate), "verdicts").withColumnRenamed("host", "verdict_host")
    out = measured.join(verdicts, F.col("host").eqNullSafe(F.col("verdict_host")))
    return out.select(
        "doc_id", *MEASURES, "base_failed", (~F.col("base_failed") & F.col("host_ok")).alias("kept"),
        "host", "host_docs", "host_failures", "host_rate",
    )
