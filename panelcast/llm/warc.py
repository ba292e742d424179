"""WARC archives: written by tasks with revisit records, read in byte ranges.

Every record is a gzip member of its own, as the format advises, so an archive
can be read from any place: a task scans its byte range for the gzip magic,
takes a candidate for a member if its first bytes decode to a WARC header,
and then owns all records that start inside its range, the last of which may
end beyond it.
"""

from __future__ import annotations

import functools
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import arrow_map, materialize
from panelcast.llm.files import make_folder, open_folder, write_whole
from panelcast.session import scratch_path

#: payloads below this size are stored each time
LEAST_REVISIT = 100
#: payload bytes after which a task starts its next archive
ARCHIVE_BYTES = 256 << 20
#: bytes of an archive that one task reads
RANGE_BYTES = 16 << 20
#: tasks of a read
MOST_TASKS = 100_000
#: bytes fetched at a time
FETCH_BYTES = 1 << 20
MAGIC = b"\x1f\x8b\x08"
#: fixed values of the format
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_URN = "urn:x-page:"


def page_urn(page_id: int | None) -> str:
    return f"<{_URN}{'none' if page_id is None else page_id}>"


def urn_page(urn: str | None) -> int | None:
    found = (urn or "").strip("<>").removeprefix(_URN)
    return int(found) if found.lstrip("-").isdigit() else None


# -- writing -----------------------------------------------------------------


def member(kind: str, fields: dict[str, str], block: bytes) -> bytes:
    """One record as a gzip member."""
    lines = {"WARC-Type": kind, "WARC-Date": DATE, **fields, "Content-Length": str(len(block))}
    head = b"".join([VERSION, b"\r\n", *(f"{k}: {v}\r\n".encode() for k, v in lines.items()), b"\r\n"])
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(head + block + b"\r\n\r\n") + pack.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
                revisit: bool) -> bytes:
    fields = {"WARC-Record-ID": page_urn(page_id)}
    if url is not None:
        fields["WARC-Target-URI"] = quote(url, safe="!#$%&'()*+,/:;=?@[]~")
    fields |= {"Content-Type": "application/http;msgtype=response", "WARC-Payload-Digest": f"sha256:{digest}",
               "X-Payload-Length": str(len(payload))}
    if revisit:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": page_urn(refers_to)}
        return member("revisit", fields, HTTP_HEAD)
    return member("response", fields, HTTP_HEAD + payload)


def _write_partition(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    part, number = TaskContext.get().partitionId(), 0
    rows = (row for batch in batches for row in batch.to_pylist())
    held = next(rows, None)
    while held is not None:
        name, count = f"pages-{part:08d}-{number:05d}.warc.gz", 0

        def records() -> Iterator[bytes]:
            nonlocal held, count
            yield member("warcinfo", {"WARC-Record-ID": f"<urn:x-archive:{name}>", "WARC-Filename": name,
                                      "Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n")
            size = 0
            while held is not None and size < ARCHIVE_BYTES:
                size += len(held["payload"])
                count += 1
                yield page_record(held["page_id"], held["url"], held["payload"], held["digest"], held["first"],
                                  held["revisit"])
                held = next(rows, None)

        size = write_whole(folder, name, records())
        yield pa.RecordBatch.from_pydict({"name": [name], "n_records": [count], "n_bytes": [size]})
        number += 1


def write_archives(pages: DataFrame, folder: str | None = None) -> tuple[str, DataFrame]:
    """Write ``page_id, url, html`` as WARC archives; returns the folder and
    the manifest ``name, n_records, n_bytes``. Only files of the manifest count.

    The payload is the html in UTF-8 (null: empty). Of pages with equal payloads of at
    least ``LEAST_REVISIT`` bytes the one with the smallest id is stored as a
    response, the others as revisits of it; smaller payloads are all stored.
    Rows without an id never are what others refer to (if no row has one, all
    are stored); repeated rows of that smallest id are all stored; other columns are not read; an
    empty table writes no file.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, f"warc-{uuid.uuid4().hex}")
    make_folder(folder)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    large = rows.where(F.octet_length("payload") >= LEAST_REVISIT)
    firsts = large.groupBy("digest").agg(F.min("page_id").alias("first"))
    # equal payloads may be a third of all rows: the join splits a digest that is too large
    known = rows.join(firsts, "digest", "left")
    known = known.withColumn("revisit", F.expr("first is not null and not (page_id <=> first)"))
    ordered = known.sortWithinPartitions("digest", "page_id", F.xxhash64("url"))
    ordered = ordered.select("page_id", "url", "payload", "digest", "first", "revisit")
    manifest = arrow_map(ordered, functools.partial(_write_partition, folder=folder),
                         "name string, n_records long, n_bytes long")
    return folder, materialize(manifest, "warc-manifest")


# -- reading -----------------------------------------------------------------


class _Window:
    """Bytes of a file, fetched as they are asked for."""

    def __init__(self, path: str, start: int):
        system, at = open_folder(path)
        self.file, self.start = system.open_input_file(at), start
        self.size = self.file.size()
        self.data = bytearray()

    def upto(self, end: int) -> None:
        """Hold the bytes before ``end``, or before the file's end."""
        while self.start + len(self.data) < min(end, self.size):
            at = self.start + len(self.data)
            self.data += self.file.read_at(min(FETCH_BYTES, self.size - at), at)

    def get(self, at: int, length: int) -> bytes:
        self.upto(at + length)
        return bytes(self.data[at - self.start : at - self.start + length])

    def drop(self, before: int) -> None:
        del self.data[: max(0, before - self.start)]
        self.start = max(self.start, before)


def _is_member(window: _Window, at: int) -> bool:
    """Whether a WARC record's gzip member begins at ``at``."""
    try:
        return zlib.decompressobj(31).decompress(window.get(at, 4096), 7).startswith(b"WARC/1.")
    except zlib.error:
        return False


def _decode_member(window: _Window, at: int) -> tuple[bytes, int] | None:
    """Content of the member at ``at`` and the place after it; None if it is broken."""
    unpack, out, place = zlib.decompressobj(31), io.BytesIO(), at
    while not unpack.eof:
        raw = window.get(place, FETCH_BYTES)
        if not raw:
            return None
        try:
            out.write(unpack.decompress(raw))
        except zlib.error:
            return None
        place += len(raw) - len(unpack.unused_data)
    return out.getvalue(), place


def records_in(path: str, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """``(place, header fields, block)`` of all records of an archive that start in ``[start, end)``."""
    window, at = _Window(path, start), start
    while at < end:
        found = _decode_member(window, at) if _is_member(window, at) else None
        if found is None:  # not at a member's start: the next candidate
            window.upto(min(end + len(MAGIC), at + FETCH_BYTES))
            stop = min(end, window.start + len(window.data))
            place = window.data.find(MAGIC, at + 1 - window.start, stop + len(MAGIC) - 1 - window.start)
            at = place + window.start if place >= 0 else max(at + 1, stop)
            window.drop(at)
            continue
        content, after = found
        head, _, rest = content.partition(b"\r\n\r\n")
        fields = {}
        for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
            key, _, value = line.partition(":")
            fields[key.strip().lower()] = value.strip()
        yield at, fields, rest[: int(fields.get("content-length", len(rest)))]
        at = after
        window.drop(at)


PAGE_SCHEMA = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, "
               "payload_digest string, payload binary")
_PAGE_COLUMNS = [c.split()[0] for c in PAGE_SCHEMA.split(", ")]


def _page_row(fields: dict[str, str], block: bytes) -> tuple:
    kind = fields["warc-type"]
    size, digest = int(fields["x-payload-length"]), fields["warc-payload-digest"].removeprefix("sha256:")
    payload = None
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if hashlib.sha256(payload).hexdigest() != digest or len(payload) != size:
            raise ValueError(f"payload of {fields.get('warc-record-id')} does not match its digest")
    return (urn_page(fields.get("warc-record-id")), fields.get("warc-target-uri"), kind,
            urn_page(fields.get("warc-refers-to")), size, digest, payload)


def _read_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("payload", pa.binary())])
    for batch in batches:
        for row in batch.to_pylist():
            rows, held = [], 0
            for _, fields, block in records_in(row["path"], row["start"], row["end"]):
                if fields.get("warc-type") not in ("response", "revisit"):
                    continue
                rows.append(_page_row(fields, block))
                held += len(block)
                if held > 8 * FETCH_BYTES:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame | None = None,
                  range_bytes: int = RANGE_BYTES) -> DataFrame:
    """A row per response or revisit record of the archives in a folder:
    ``page_id, url, record_type, refers_to, payload_bytes, payload_digest,
    payload`` (null for revisits). Sizes and digests are those of the full
    payload; a response's are checked against what was read. Files not in the manifest, if one
    is given, are left out.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("path", "length")
    if manifest is not None:
        files = files.withColumn("name", F.element_at(F.split("path", "/"), -1)).join(manifest, "name", "left_semi")
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long")))
    ranges = files.where("length > 0").select("path", "length", starts.alias("start"))
    ranges = ranges.select("path", "start", F.least(F.col("start") + range_bytes, "length").alias("end"))
    # a task per range (several where there are very many): their number is given, so they are
    # not merged for being few bytes to shuffle
    tasks = files.agg(F.sum(F.ceil(F.col("length") / range_bytes))).first()[0] or 1
    dealt = ranges.repartition(min(int(tasks), MOST_TASKS))
    return arrow_map(dealt, _read_ranges, PAGE_SCHEMA)
