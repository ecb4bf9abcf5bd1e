"""WARC bundles: seekable Zstandard archives of WARC records.

Each bundle is a sequence of independent Zstandard frames, every frame holding
a group of whole records up to ``FRAME_BYTES``, and ends in a skippable frame
with the seek table (compressed and decompressed size of each frame), as in the
public seekable format. A record is found by its identifier through an index
of (bundle, frame, offset in the decompressed frame, length): reading one needs
the seek table and one frame.

Records are WARC/1.1: a response's block is an HTTP response with the payload
as its body, a revisit follows the identical-payload-digest profile and names
the response by target and date. Record ids are unique (one namespace a
write, partition and place within it), dates are the time of the write, and
the page a record stands for has fields of its own, so repeated page_ids do no
harm.

Bundles are rows of a Parquet table in the shared folder, so Spark's commit
protocol makes a rerun of a lost task harmless. Records with equal payloads of
at least ``MIN_REVISIT`` bytes are written once: the largest page_id is the
response, the others revisit it. The sums per digest are map-side combined
and written, so the join back is one that AQE can split at a hot payload.

Defined cases: null html is an empty payload; a page without url has
``urn:page:<page_id>`` as its target and comes back without; a null page_id is
written as ``null`` and comes back as null; of repeated rows with the same
page_id and payload, all are responses if that id is the group's largest; of
rows that tie for it, revisits name the one with the largest url. A page larger
than a frame or a bundle fills one of its own, whole. An empty table gives
archives without records or none, and no rows. Further columns of ``pages``,
whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

MIN_REVISIT = 1000
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 4 << 20
LEVEL = 3
# Fixed values of the seekable format: skippable frame and seek table magics.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
# Fixed value of the WARC standard: the profile of revisits.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

BUNDLES = ("bundle string, data binary, "
           "entries array<struct<page_id:bigint, record_id:string, frame:int, offset:int, length:int>>")
RECORDS = ("page_id bigint, record_id string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
           "url string, payload binary")


def decisions(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) with the digest of the payload and, for
    revisits, refers_to and refers_url (page_id and url of the response)."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    p = pages.select("page_id", "url", body.alias("payload")).withColumn("digest", F.sha1("payload"))
    large = p.where(F.octet_length("payload") >= MIN_REVISIT)
    groups = large.groupBy(F.col("digest").alias("d")).agg(
        F.max(F.struct("page_id", "url")).alias("top"), F.count("*").alias("n"))
    groups = groups.where("n > 1").select("d", F.col("top.page_id").alias("largest"), F.col("top.url").alias("largest_url"))
    out = p.join(materialize(groups, "warc-groups"), F.col("digest") == F.col("d"), "left")
    other = F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest"))
    return out.select("page_id", "url", "payload", "digest", F.when(other, F.col("largest")).alias("refers_to"),
                      F.when(other, F.col("largest_url")).alias("refers_url"))


def target(page_id, url) -> str:
    """The target of a page: its url on one line, or a name made of its id."""
    if url is None:
        return f"urn:page:{'null' if page_id is None else page_id}"
    return url.replace("\r", "%0D").replace("\n", "%0A")


def record(record_id: str, date: str, page_id, url, payload: bytes, digest: str, refers_to=None, refers_url=None) -> bytes:
    """One WARC/1.1 record; a revisit has no block."""
    kind = "response" if refers_to is None else "revisit"
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}",
            f"WARC-Target-URI: {target(page_id, url)}", f"WARC-Payload-Digest: sha1:{digest}",
            f"X-Page-ID: {'null' if page_id is None else page_id}"]
    if url is None:
        head.append("X-Page-URL: null")
    block = b""
    if refers_to is None:
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
        block = http.encode() + payload
        head.append("Content-Type: application/http; msgtype=response")
    else:
        head += [f"WARC-Refers-To-Target-URI: {target(refers_to, refers_url)}", f"WARC-Refers-To-Date: {date}",
                 f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-ID: {refers_to}", f"X-Payload-Length: {len(payload)}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


class BundleWriter:
    """Collects records into frames and frames into one archive."""

    def __init__(self):
        self.packer = zstandard.ZstdCompressor(level=LEVEL)
        self.data, self.table, self.entries = [], [], []
        self.frame, self.frame_size, self.size = [], 0, 0

    def add(self, page_id, record_id: str, rec: bytes):
        if self.frame and self.frame_size + len(rec) > FRAME_BYTES:
            self.flush()
        self.entries.append({"page_id": page_id, "record_id": record_id, "frame": len(self.table),
                             "offset": self.frame_size, "length": len(rec)})
        self.frame.append(rec)
        self.frame_size += len(rec)
        self.size += len(rec)

    def flush(self):
        packed = self.packer.compress(b"".join(self.frame))
        self.data.append(packed)
        self.table.append((len(packed), self.frame_size))
        self.frame, self.frame_size = [], 0

    def close(self) -> dict:
        if self.frame:
            self.flush()
        rows = b"".join(struct.pack("<II", *x) for x in self.table)
        footer = struct.pack("<IBI", len(self.table), 0, SEEKABLE)
        tail = struct.pack("<II", SKIPPABLE, len(rows) + len(footer)) + rows + footer
        data = b"".join([*self.data, tail])
        return {"bundle": hashlib.sha1(data).hexdigest(), "data": data, "entries": self.entries}


def seek_table(data: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed size, decompressed size) of each frame, from the
    footer alone."""
    n, _, magic = struct.unpack("<IBI", data[-9:])
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    out, at = [], 0
    for k in range(n):
        c, d = struct.unpack_from("<II", data, len(data) - 9 - 8 * (n - k))
        out.append((at, c, d))
        at += c
    return out


def read_frame(data: bytes, frame: tuple[int, int, int]) -> bytes:
    start, packed, size = frame
    return zstandard.ZstdDecompressor().decompress(data[start : start + packed], max_output_size=size)


def parse(rec: bytes) -> dict:
    """Fields of one record."""
    head, _, rest = rec.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8", "replace").split("\r\n")[1:])
    number = lambda s: None if s in (None, "null") else int(s)
    revisit = fields["WARC-Type"] == "revisit"
    body = None if revisit else rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]
    return {
        "page_id": number(fields["X-Page-ID"]), "record_id": fields["WARC-Record-ID"][1:-1],
        "payload_bytes": int(fields["X-Payload-Length"]) if revisit else len(body),
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:") if revisit else hashlib.sha1(body).hexdigest(),
        "record_type": fields["WARC-Type"], "refers_to": number(fields.get("X-Refers-To-Page-ID")),
        "url": None if "X-Page-URL" in fields else fields["WARC-Target-URI"], "payload": body,
    }


def write_bundles(decided: DataFrame, date: str | None = None) -> DataFrame:
    """Rows of archives; a task keeps one bundle in memory at a time. ``date``
    (``2024-05-06T07:08:09Z``) is the records' date, now if not given: it and
    the ids' namespace are set once, so a task run again writes the same."""
    from pyspark import TaskContext
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(BUNDLES))
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    namespace = uuid.uuid4()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, part, place = BundleWriter(), TaskContext.get().partitionId(), 0
        for b in batches:
            for values in zip(*b.columns, strict=True):
                page = [x.as_py() for x in values]
                record_id = uuid.uuid5(namespace, f"{part}:{place}").urn
                place += 1
                w.add(page[0], record_id, record(record_id, date, *page))
                if w.size >= BUNDLE_BYTES:
                    yield pa.RecordBatch.from_pylist([w.close()], schema)
                    w = BundleWriter()
        if w.entries:
            yield pa.RecordBatch.from_pylist([w.close()], schema)

    columns = decided.select("page_id", "url", "payload", "digest", "refers_to", "refers_url")
    return materialize(columns.mapInArrow(pack, BUNDLES), "warc-bundles")


def read_records(bundles: DataFrame) -> DataFrame:
    """Every record of every archive, frame by frame."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(RECORDS))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data, entries in zip(b.column(0), b.column(1), strict=True):
                raw, rows = data.as_py(), {}
                for e in entries.as_py():
                    rows.setdefault(e["frame"], []).append(e)
                for k, frame in enumerate(seek_table(raw)):
                    text = read_frame(raw, frame)
                    yield pa.RecordBatch.from_pylist(
                        [parse(text[e["offset"] : e["offset"] + e["length"]]) for e in rows.get(k, [])], schema)

    return bundles.select("data", "entries").mapInArrow(unpack, RECORDS)


def fetch(bundles: DataFrame, wanted: DataFrame) -> DataFrame:
    """Records of the identifiers in ``wanted`` (page_id), reading only the
    frames that hold them."""
    index = bundles.select("bundle", F.explode("entries").alias("e")).select("bundle", "e.*")
    hit = index.join(wanted.select("page_id").distinct(), "page_id").groupBy("bundle").agg(
        F.collect_list(F.struct("page_id", "record_id", "frame", "offset", "length")).alias("entries"))
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(RECORDS))

    def seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data, entries in zip(b.column(0), b.column(1), strict=True):
                raw, frames, open_frames = data.as_py(), None, {}
                frames = seek_table(raw)
                out = []
                for e in entries.as_py():
                    if e["frame"] not in open_frames:
                        open_frames[e["frame"]] = read_frame(raw, frames[e["frame"]])
                    out.append(parse(open_frames[e["frame"]][e["offset"] : e["offset"] + e["length"]]))
                yield pa.RecordBatch.from_pylist(out, schema)

    return bundles.select("bundle", "data").join(hit, "bundle").select("data", "entries").mapInArrow(seek, RECORDS)


def q_op7(spark, sf):
    """Writes every page, reads the archives back, and returns what they say."""
    bundles = write_bundles(decisions(spark.read.parquet(f"{sf}/pages.parquet")))
    return read_records(bundles).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL_OP7 = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS h FROM p),
g AS (SELECT h, max(page_id) AS top FROM d WHERE n >= 1000 GROUP BY h)
SELECT d.page_id, CAST(n AS BIGINT) AS payload_bytes, d.h AS payload_digest,
       CASE WHEN g.top IS NOT NULL AND d.page_id IS DISTINCT FROM g.top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN d.page_id IS DISTINCT FROM g.top THEN g.top END AS refers_to
FROM d LEFT JOIN g ON d.h = g.h AND d.n >= 1000
"""
