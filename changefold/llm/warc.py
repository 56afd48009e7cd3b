"""WARC archives of web pages, with an index by which records are read back.

Pages with equal payloads are one response record and revisit records that refer to it.
Every task writes archives of its own, one gzip member per record, and the index gets the
place of each record. Only archives that the index names are read, so what a lost or
repeated task has left behind is never seen.
"""

from __future__ import annotations

import base64
import hashlib
import math
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefold.llm.frames import ship
from changefold.session import materialize, new_run_dir

#: Bytes of an archive after which a task begins the next one.
ARCHIVE_BYTES = 256 << 20
#: Records this near each other are read in one go, up to so many bytes.
GAP_BYTES = 64 << 10
READ_BYTES = 4 << 20
#: Bytes of archives for each task that reads them.
TASK_BYTES = 32 << 20
LEVEL = 4
INDEX = "path string, offset bigint, length bigint, url string, digest string"
RECORD = ("page_id bigint, url string, payload_bytes bigint, payload_digest string, "
          "record_type string, refers_to bigint")
TIME = "1970-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"


def _id(name: str) -> int | None:
    return int(name[10:-1]) if name.startswith("<urn:page:") else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A record as one gzip member. A revisit tells its payload's digest and size only."""
    kind = "response" if refers_to is None else "revisit"
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", _name(page_id)), ("WARC-Date", TIME),
        ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"), ("X-Payload-Length", str(len(payload))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if refers_to is not None:
        fields += [("WARC-Refers-To", _name(refers_to)), (
            "WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    block = payload if refers_to is None else b""
    fields += [("Content-Type", "text/html"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    press = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return press.compress(head.encode() + block + b"\r\n\r\n") + press.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    if not data.startswith(b"WARC/1.1\r\n") or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    return fields, block


def _write(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    files, base = pafs.FileSystem.from_uri(folder)
    files.create_dir(base, recursive=True)
    sink, name, at = None, "", 0
    for batch in batches:
        for page in range(0, batch.num_rows, 256):
            rows = []
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.slice(page, 256).columns), strict=True):
                payload = (html or "").encode()
                if sink is None or at > ARCHIVE_BYTES:
                    if sink is not None:
                        sink.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    sink = files.open_output_stream(f"{base}/{name}", compression=None)
                data = record(page_id, url, payload, refers_to)
                sink.write(data)
                rows.append((f"{folder}/{name}", at, len(data), url, payload_digest(payload)))
                at += len(data)
            cols = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)],
                names=["path", "offset", "length", "url", "digest"])
    if sink is not None:
        sink.close()


def referred(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html",
             least: int = 0) -> DataFrame:
    """(page_id, url, html, refers_to). Of pages with equal payloads of at least ``least``
    bytes the largest id is kept whole (every row that bears it), the others refer to it.

    A null html is empty; a page without an id refers to another, never the other way.
    Payloads meet as digests; what joins them is split where one payload is very common.
    """
    rows = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
                        F.col(f"`{html}`").alias("html"))
    rows = rows.withColumn("sha", F.sha1(F.coalesce("html", F.lit("")).cast("binary")))
    size = F.octet_length(F.coalesce("html", F.lit("")))
    owners = rows.filter(size >= least).groupBy("sha").agg(
        F.max("page_id").alias("owner"), F.count("*").alias("copies")).filter(
        "copies > 1 AND owner IS NOT NULL").select("sha", "owner")
    return rows.join(owners, "sha", "left").select("page_id", "url", "html", F.when(
        (size >= least) & ~F.col("page_id").eqNullSafe(F.col("owner")), F.col("owner")).alias("refers_to"))


def write(pages: DataFrame, folder: str | None = None, **names) -> DataFrame:
    """Write archives into a folder that all executors share, and return their index, which
    is written there too."""
    spark = pages.sparkSession
    ship(spark)
    folder = folder or new_run_dir(spark, "warc")
    found = referred(pages, **names).mapInArrow(partial(_write, folder=folder), INDEX)
    return materialize(found, "warc-index")


def ranges(places: list[tuple[int, int]]) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """Sorted (offset, length) as few reads: start, end and the places inside."""
    start, end, held = 0, 0, []
    for offset, length in places:
        if held and (offset - end > GAP_BYTES or offset + length - start > READ_BYTES):
            yield start, end, held
            held = []
        if not held:
            start = end = offset
        held.append((offset, length))
        end = max(end, offset + length)
    if held:
        yield start, end, held


def records(batch: pa.RecordBatch) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records at the sorted places of ``batch`` (path, offset, length)."""
    at: dict[str, list[tuple[int, int]]] = {}
    for path, offset, length in zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True):
        at.setdefault(path, []).append((offset, length))
    for path, places in at.items():
        files, name = pafs.FileSystem.from_uri(path)
        with files.open_input_file(name) as source:
            for start, end, held in ranges(places):
                data = source.read_at(end - start, start)
                for offset, length in held:
                    yield parse(data[offset - start:offset - start + length])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            rows = []
            for fields, block in records(batch.slice(lo, 256)):
                digest, kind = fields["WARC-Payload-Digest"][5:], fields["WARC-Type"]
                if kind == "response" and payload_digest(block) != digest:
                    raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
                refers = fields.get("WARC-Refers-To")
                rows.append((_id(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"),
                             int(fields["X-Payload-Length"]), digest, kind, refers and _id(refers),
                             block if kind == "response" else None))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def read(index: DataFrame) -> DataFrame:
    """The records that ``index`` names, or a selection of it, in sorted reads of near ranges.

    An archive's records are dealt in stretches of a few reads, so that a large archive is
    read by many tasks. Their number follows the bytes of the records, not of the index.
    """
    ship(index.sparkSession)
    stretch = F.floor(F.col("offset") / READ_BYTES)
    size = index.agg(F.sum("length")).first()[0] or 0
    sorted_places = index.select("path", "offset", "length").repartition(
        max(1, math.ceil(size / TASK_BYTES)), "path", stretch).sortWithinPartitions("path", "offset")
    return sorted_places.mapInArrow(_read, f"{RECORD}, payload binary")
