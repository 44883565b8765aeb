"""WARC archives: record-at-a-time writer and splittable reader (operator 8).

Writing. Every record is a gzip member of its own. Spark's text writer puts
the members into files on whatever store the path names, with its commit
protocol: a member's last byte is the high byte of the length field, zero
below 16 MiB, and is supplied as the line separator; a larger record is
followed by an empty member, whose last byte is always zero. Of records with
equal payloads (SHA-1) of at least ``min_bytes`` bytes the one with the largest
page_id is a response and the others revisit it.

Reading. Files are split by byte ranges. Every task cuts its range at the gzip
magic; the candidate after it is a record's start only if the record before is
complete and the candidate decodes to a WARC header, otherwise the magic was
data and the bytes go on. The task whose range a record starts in owns it.
When a false magic lies beyond the range, what is missing of the last record is
the head of the next range: such fragments, a few per file at most, are put
together per file. (A payload that itself holds an uncompressed gzip WARC member
right at a range's start would be misread.)

Rows: a null html is an empty payload; rows with equal largest page_id are all
responses; a null page_id is the smallest and reads back as null; a null url
has no target line; control characters in urls are escaped; extra columns are
not read. An empty table writes no record and reads back empty.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.llm.common import folder, store

MAGIC = b"\x1f\x8b\x08"
LEVEL = 6
FIELDS = "page_id long, record_type string, url string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(data: bytes) -> bytes:
    c = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def record(page_id, url, payload: bytes, refers_to, date: str) -> bytes:
    name = lambda i: f"<urn:page:{'null' if i is None else i}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha1:{digest(payload)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {name(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        payload = b""
    body = http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _members(date: str):
    def run(batches):
        for batch in batches:
            out = []
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = member(record(page_id, url, (html or "").encode(), refers_to, date))
                if data[-1]:
                    data += member(b"")
                out.append(data[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    return run


def write(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write the pages (page_id, url, html) as gzip WARC files into the folder ``path``."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1(F.col("html").cast("binary")))
    equal = (
        rows.where(F.octet_length("html") >= min_bytes).groupBy("sha")
        .agg(F.count("*").alias("copies"), F.max("page_id").alias("first")).where("copies > 1")
    )
    equal = store(equal.select(F.col("sha").alias("of"), "first"), "equal")
    rows = rows.join(equal, F.col("sha") == F.col("of"), "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    out = rows.select("page_id", "url", "html", refers.alias("refers_to")).mapInArrow(_members(date), "value binary")
    out.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\0").text(path)


class _Open:
    """A record being decoded."""

    def __init__(self, data: bytes):
        self.d, self.raw, self.out = zlib.decompressobj(31), [data], []
        self.out.append(self.d.decompress(data))

    def add(self, data: bytes) -> None:
        self.raw.append(data)
        self.out.append(self.d.decompress(data))


def starts(data: bytes) -> bool:
    """Whether a candidate decodes to the beginning of a WARC header."""
    try:
        return zlib.decompressobj(31).decompress(data, 16).startswith(b"WARC/")
    except zlib.error:
        return False


def _filler(data: bytes) -> bool:
    """Whether a candidate is an empty member."""
    try:
        d = zlib.decompressobj(31)
        return d.decompress(data, 1) == b"" and d.eof
    except zlib.error:
        return False


def parse(data: bytes, with_payload: bool):
    """The fields of a decoded record; the payload of a response is checked against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    body = rest[: int(lines["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    number = lambda x: None if x is None or x == "<urn:page:null>" else int(x[len("<urn:page:") : -1])
    kind, claimed = lines["WARC-Type"], lines["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    if kind == "response" and (digest(payload) != claimed or len(payload) != size):
        raise ValueError(f"damaged record {lines['WARC-Record-ID']}")
    return (
        number(lines["WARC-Record-ID"]), kind, lines.get("WARC-Target-URI"), size, claimed,
        number(lines.get("WARC-Refers-To")), payload if with_payload and kind == "response" else None,
    )


def _batch(found, fragments):
    """Records and fragments (file, range start, order, bytes) as one batch."""
    cols = list(zip(*found, strict=True)) or [[]] * 7
    n, m = len(found), len(fragments)
    types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
    arrays = [pa.array([*c, *[None] * m], t) for c, t in zip(cols, types, strict=True)]
    for k, t in enumerate((pa.string(), pa.int64(), pa.int32(), pa.binary())):
        arrays.append(pa.array([*[None] * n, *[f[k] for f in fragments]], t))
    return pa.RecordBatch.from_arrays(arrays, [x.split()[0] for x in FIELDS.split(", ")] + ["file", "range", "part", "bytes"])


def _records(with_payload: bool):
    def run(batches):
        at, now, found, fragments = None, None, [], []

        def finish():
            if now is not None:
                if now.d.eof:
                    found.append(parse(b"".join(now.out), with_payload))
                else:
                    fragments.append((*at, 1, b"".join(now.raw)))

        for batch in batches:
            for file, start, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (file, start) != at:
                    finish()
                    at, now, first = (file, start), None, start == 0
                    if first and not piece:
                        continue  # before the first magic of the file
                data = MAGIC + piece
                if now is not None and not now.d.eof:
                    now.add(data)
                elif starts(data):
                    finish()
                    now = _Open(data)
                elif not _filler(data):
                    fragments.append((*at, 0, data))
            if found or fragments:
                yield _batch(found, fragments)
                found.clear()
                fragments.clear()
        finish()
        if found or fragments:
            yield _batch(found, fragments)

    return run


def _mend(with_payload: bool):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("range", "ascending"), ("part", "ascending")])
        found, now = [], None
        for tail, data in zip(table.column("part").to_pylist(), table.column("bytes").to_pylist(), strict=True):
            if tail:
                now = _Open(data)
            elif now is not None and not now.d.eof:
                now.add(data)
            else:
                raise ValueError("bytes that belong to no record")
            if now.d.eof:
                found.append(parse(b"".join(now.out), with_payload))
                now = None
        if now is not None:
            raise ValueError("a record without its end")
        return pa.Table.from_batches([_batch(found, [])]).select(range(7))

    return run


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of the WARC files in ``path``: page_id, record_type, url, payload_bytes, payload_digest, refers_to, payload."""
    lines = spark.read.option("lineSep", MAGIC.decode("latin1")).option("encoding", "ISO-8859-1").text(path)
    cut = lines.select("_metadata.file_path", "_metadata.file_block_start", F.col("value").cast("binary").alias("value"))
    cut = cut.mapInArrow(_records(with_payload), f"{FIELDS}, file string, range long, part int, bytes binary")
    cut = store(cut, "records")
    names = [x.split()[0] for x in FIELDS.split(", ")]
    whole = cut.where("file is null").select(*names)
    torn = cut.where("file is not null").select("file", "range", "part", "bytes")
    if torn.isEmpty():
        return whole
    return whole.unionByName(torn.groupBy("file").applyInArrow(_mend(with_payload), FIELDS))


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the pages as archives into the shared folder and read them back."""
    path = folder(pages.sparkSession, "warc")
    write(pages, path, min_bytes)
    return read(pages.sparkSession, path, with_payload=False).drop("payload")
