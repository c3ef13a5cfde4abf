"""WARC records in ZIP packages: written by tasks, read by ranges without unpacking.

A package holds a stored (not deflated) WARC member, whose records are Zstandard frames of
their own (plain and gzip members are read as well), and a stored index of where each record
lies.  The reader parses the end of central directory, its ZIP64 form and the central directory, locates
the members, and reads the index and then blocks of records by byte ranges.  Files are reached
through Arrow's file systems, so a package may lie wherever all executors can reach it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkledger.llm.common import staged

DATA, INDEX = "archive/data.warc.zst", "indexes/index.cdxj"
#: A package is closed at this many records or bytes and the next one begun, which bounds its index in memory.
RECORDS, BYTES = 50_000, 512 << 20
#: Records next to each other are read together up to this many bytes.
BLOCK = 8 << 20
DATE = "2024-01-01T00:00:00Z"


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a URI; a bare path is on a shared mount."""
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record: a response with its payload, or a revisit that names another record and has none."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
            f"WARC-Date: {DATE}", "Content-Type: application/http;msgtype=response",
            f"WARC-Payload-Digest: sha1:{digest_of(payload)}"]
    if url is not None:
        clean = "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)
        head.append(f"WARC-Target-URI: {clean}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(refers_to)}"]
    body = http if revisit else http + payload
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


class PackageWriter:
    """Appends records to packages below ``folder``; ``paths`` are the closed ones."""

    def __init__(self, folder: str):
        self.folder, self.paths, self.zip, self.packer = folder, [], None, zstandard.ZstdCompressor(level=3)
        opened(folder)[0].create_dir(opened(folder)[1], recursive=True)

    def _open(self) -> None:
        self.path = f"{self.folder}/{uuid.uuid4().hex}.wacz"
        where, path = opened(self.path)
        self.stream = where.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.at, self.lines = 0, []

    def add(self, page_id: int | None, record: bytes) -> None:
        if self.zip is None:
            self._open()
        packed = self.packer.compress(record)
        self.member.write(packed)
        self.lines.append(json.dumps({"page_id": page_id, "offset": self.at, "length": len(packed)}))
        self.at += len(packed)
        if len(self.lines) >= RECORDS or self.at >= BYTES:
            self.close()

    def close(self) -> None:
        if self.zip is not None:
            self.member.close()
            self.zip.writestr(zipfile.ZipInfo(INDEX), "".join(f"{line}\n" for line in self.lines))
            self.zip.close()
            self.stream.close()
            self.paths.append((self.path, len(self.lines)))
            self.zip = None


def write_packages(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html",
                   min_bytes: int = 0) -> DataFrame:
    """One WARC record per row of ``pages`` in packages below ``folder``; returns ``(path, records)``, staged.

    The payload is the html in UTF-8, empty for null.  Of rows with equal payloads of at least
    ``min_bytes`` bytes the one with the largest id is a response, the others revisit it; repeated
    rows with that id are all responses, as are rows of a group that has no id at all.  A retried
    task writes packages of its own, and only those of the attempt that counted are returned.
    """
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).cast("bigint").alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    # only payloads that occur twice are looked up, written first so that few of them are sent to the rows
    groups = (rows.filter(F.length("payload") >= min_bytes).groupBy("digest")
              .agg(F.max("page_id").alias("origin"), F.count(F.lit(1)).alias("_n")).filter("_n > 1 AND origin IS NOT NULL"))
    marked = (rows.join(staged(groups.select("digest", "origin"), "warc-groups"), "digest", "left")
              .select("page_id", "url", "payload", "origin"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = PackageWriter(folder)
        for batch in batches:
            for page_id, address, data, origin in zip(*(c.to_pylist() for c in batch.columns)):
                revisit = origin is not None and page_id != origin
                writer.add(page_id, record_bytes(page_id, address, data, origin, revisit))
        writer.close()
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in writer.paths], pa.string()),
                                          pa.array([n for _, n in writer.paths], pa.int64())], ["path", "records"])

    return staged(marked.mapInArrow(write, "path string, records bigint"), "warc-manifest")


@dataclass(frozen=True)
class Member:
    """A member of a package: where its bytes are and how they are kept (0: stored)."""

    name: str
    method: int
    start: int
    size: int


def _wide(extra: bytes, fields: list[int]) -> list[int]:
    """Fill 32-bit fields that are all ones from the ZIP64 extra field, in order."""
    at = 0
    while at + 4 <= len(extra):
        tag, size = struct.unpack_from("<HH", extra, at)
        if tag == 1:
            place, out = at + 4, []
            for value in fields:
                if value == 0xFFFFFFFF:
                    value, = struct.unpack_from("<Q", extra, place)
                    place += 8
                out.append(value)
            return out
        at += 4 + size
    return fields


def members(file) -> list[Member]:
    """The central directory of a package, read from its end; ``file`` seeks and reads.

    Reads the last 64 KB, the directory, and a header per member; never a member itself.
    """
    size = file.seek(0, 2) or file.tell()
    tail_at = max(0, size - 65557)
    file.seek(tail_at)
    tail = file.read(size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    # a comment may hold the same bytes: the real one's comment ends with the file
    while end >= 0 and (end + 22 > len(tail) or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
        end = tail.rfind(b"PK\x05\x06", 0, end)
    if end < 0:
        raise ValueError("no end of central directory: not a ZIP package, or cut short")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    if end >= 20 and tail[end - 20:end - 16] == b"PK\x06\x07" and (count == 0xFFFF or 0xFFFFFFFF in (length, start)):
        file.seek(struct.unpack_from("<Q", tail, end - 12)[0])
        wide = file.read(56)
        if wide[:4] != b"PK\x06\x06":
            raise ValueError("the ZIP64 end of central directory is not where its locator says")
        count, length, start = struct.unpack_from("<QQQ", wide, 32)
    file.seek(start)
    directory, at, found = file.read(length), 0, []
    for _ in range(count):
        if directory[at:at + 4] != b"PK\x01\x02":
            raise ValueError("the central directory ends early")
        method, = struct.unpack_from("<H", directory, at + 10)
        packed, full, names, extras, comments = struct.unpack_from("<IIHHH", directory, at + 20)
        offset, = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + 46:at + 46 + names].decode("utf-8", "replace")
        extra = directory[at + 46 + names:at + 46 + names + extras]
        full, packed, offset = _wide(extra, [full, packed, offset])
        found.append((name, method, packed, offset))
        at += 46 + names + extras + comments
    out = []
    for name, method, packed, offset in found:
        file.seek(offset)
        header = file.read(30)
        if header[:4] != b"PK\x03\x04":
            raise ValueError(f"{name} is not where the central directory says")
        out.append(Member(name, method, offset + 30 + sum(struct.unpack_from("<HH", header, 26)), packed))
    return out


def _blocks(path: str) -> Iterator[tuple[str, int, int]]:
    """(path, start, length) of the record blocks of one package, from its index, or its WARC members whole without one."""
    where, name = opened(path)
    with where.open_input_file(name) as file:
        stored = {m.name: m for m in members(file) if m.method == 0}
        archives = [m for m in stored.values() if m.name.endswith((".warc", ".warc.gz", ".warc.zst"))]
        index = next((m for m in stored.values() if m.name.startswith("indexes/")), None)
        if index is None or len(archives) != 1:
            yield from ((path, m.start, m.size) for m in archives)
            return
        file.seek(index.start)
        start = end = 0
        rest, left = b"", index.size
        while left or rest:
            part = file.read(min(left, 1 << 20))
            left -= len(part)
            lines = (rest + part).split(b"\n")
            rest = lines.pop() if left else b""
            for line in filter(None, lines):
                entry = json.loads(line[line.index(b"{"):])
                if entry["offset"] != end or entry["offset"] + entry["length"] - start > BLOCK:
                    if end > start:
                        yield path, archives[0].start + start, end - start
                    start = entry["offset"]
                end = entry["offset"] + entry["length"]
        if end > start:
            yield path, archives[0].start + start, end - start


def unpacked(data: bytes) -> io.BufferedIOBase:
    """``data`` as a stream of records: gzip members and Zstandard frames are unpacked as they are read."""
    raw = io.BytesIO(data)
    if data[:2] == b"\x1f\x8b":
        return gzip.GzipFile(fileobj=raw)
    if data[:4] == b"\x28\xb5\x2f\xfd":
        return io.BufferedReader(zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True), 1 << 16)
    return raw


def parsed_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, body) of the WARC records in ``data``, plain or packed, which starts and ends between records."""
    stream = unpacked(data)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record where one should begin: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        body = stream.read(size)
        if len(body) != size:
            raise ValueError("a WARC record ends early")
        yield headers, body


def _page(value: str | None) -> int | None:
    """The id in a record id; null for records without one."""
    text = (value or "").removeprefix("<urn:x-page:").removesuffix(">")
    return int(text) if text.lstrip("-").isdigit() else None


_ROW = ("page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
        "payload binary")


def _rows(data: bytes) -> Iterator[tuple]:
    for headers, body in parsed_records(data):
        if headers.get("warc-type") not in ("response", "revisit"):
            continue
        http, _, payload = body.partition(b"\r\n\r\n")
        digest = headers["warc-payload-digest"].removeprefix("sha1:")
        response = headers["warc-type"] == "response"
        if response and digest_of(payload) != digest:
            raise ValueError(f"the payload of {headers['warc-record-id']} does not have its digest")
        # a revisit has no payload; its HTTP header still says how long it is
        size = len(payload) if response else next(
            int(line.partition(b":")[2]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:"))
        yield (_page(headers["warc-record-id"]), headers.get("warc-target-uri"), size, digest, headers["warc-type"],
               _page(headers.get("warc-refers-to")), payload if response else None)


def _row_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 7, kinds)],
                                      ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])


def read_packages(paths: DataFrame, path: str = "path") -> DataFrame:
    """The records of the packages named in ``paths``, a row each; a revisit's ``payload`` is null.

    A package's directory and index are read first; then blocks of neighbouring records, at
    most ``BLOCK`` bytes unless one record is longer, are dealt to tasks and read by range.
    Deflated members are not archives and are passed over.  A payload that does not have the
    digest its record states, or a package that is cut short, is an error.
    """
    spark = paths.sparkSession

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                blocks = list(_blocks(name))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*blocks) if blocks else ([], [], []), (pa.string(), pa.int64(), pa.int64()))],
                    ["path", "start", "length"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start, length in zip(*(c.to_pylist() for c in batch.columns)):
                where, place = opened(name)
                with where.open_input_file(place) as file:
                    file.seek(start)
                    data = file.read(length)
                # rows leave as they are read: a block may unpack to many times its size
                rows, held = [], 0
                for row in _rows(data):
                    rows.append(row)
                    held += len(row[-1] or b"")
                    if held > BLOCK or len(rows) >= 1000:
                        yield _row_batch(rows)
                        rows, held = [], 0
                yield _row_batch(rows)

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = paths.select(F.col(path).alias("path")).repartition(tasks).mapInArrow(plan, "path string, start bigint, length bigint")
    return blocks.repartition(tasks).mapInArrow(read, _ROW)
