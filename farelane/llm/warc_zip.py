"""WARC records in ZIP packages: written by tasks, read by ranges.

A package holds two stored members, the records (each compressed on its own) and an index
with one line per record. The reader takes three small ranges of a package (its end, its
central directory, its index) to learn where records lie, and then only the ranges of the
records it is asked for. Nothing is extracted, and the work is dealt out by ranges, not by
packages.

Packages are reached through ``pyarrow.fs`` by URI, so the folder can be any store all
executors share. A task writes packages under names of its own and returns them with its
result, so files of failed attempts are never read.

Cases, by definition:

* null html is an empty payload; payloads of equal bytes and at least ``min_bytes`` are
  one response, of the smallest id, and revisits that refer to it;
* rows that repeat the smallest id are responses all; a null id is never smallest, and a
  payload that only rows without an id have gives responses;
* payloads below ``min_bytes`` are always responses; an empty table gives no package;
* null URLs give records without a target; line breaks in URLs are percent-encoded;
* other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import struct
import uuid
import zipfile
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.llm.common import land, map_batches
from farelane.session import working_folder

MIN_BYTES = 100
RECORDS, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
#: Bytes of records per package, and per unit of reading.
PACKAGE_BYTES = 64 << 20
READ_BYTES = 4 << 20
_DATE = "2020-01-01T00:00:00Z"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Signatures and field layouts of the public ZIP format.
_END, _END64, _LOCATOR64, _CENTRAL, _LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"
_WIDE4, _WIDE2 = 0xFFFFFFFF, 0xFFFF


class Member(NamedTuple):
    name: str
    start: int
    size: int


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


class RangeReader:
    """Byte ranges of one file; counts what it read."""

    def __init__(self, uri: str):
        fs, path = _open(uri)
        self.file = fs.open_input_file(path)
        self.size, self.bytes_read = self.file.size(), 0

    def read(self, start: int, size: int) -> bytes:
        self.bytes_read += size
        found = self.file.read_at(size, start)
        if len(found) != size:
            raise ValueError(f"the package ends before byte {start + size}")
        return found


def stored_members(reader: RangeReader) -> dict[str, Member]:
    """The stored members of a ZIP file, from its central directory (ZIP64 included)."""
    tail_start = max(0, reader.size - 22 - 0xFFFF)
    tail = reader.read(tail_start, reader.size - tail_start)
    end = tail.rfind(_END)
    # The signature may stand in the note too; only at the true end does the note fill the file.
    while end >= 0 and (end + 22 > len(tail) or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
        end = tail.rfind(_END, 0, end)
    if end < 0:
        raise ValueError("no end of central directory: not a ZIP file, or cut off")
    count, size, start = struct.unpack_from("<HII", tail, end + 10)
    if count == _WIDE2 or _WIDE4 in (size, start):
        at = tail_start + end - 20
        locator = reader.read(at, 20)
        if locator[:4] != _LOCATOR64:
            raise ValueError("no ZIP64 locator")
        wide = reader.read(struct.unpack_from("<Q", locator, 8)[0], 56)
        if wide[:4] != _END64:
            raise ValueError("no ZIP64 end of central directory")
        count, size, start = struct.unpack_from("<QQQ", wide, 32)
    directory = reader.read(start, size)
    found, at = {}, 0
    for _ in range(count):
        if directory[at : at + 4] != _CENTRAL:
            raise ValueError("the central directory is damaged")
        method, packed, plain, name_size, extra_size, note_size = struct.unpack_from("<10xH8xIIHHH", directory, at)
        header = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46 : at + 46 + name_size].decode()
        extra = directory[at + 46 + name_size : at + 46 + name_size + extra_size]
        while len(extra) >= 4:
            kind, length = struct.unpack_from("<HH", extra)
            if kind == 1:  # the wide fields stand in this order, each only where its narrow one is full
                wide = iter(struct.unpack_from(f"<{length // 8}Q", extra, 4))
                plain = next(wide) if plain == _WIDE4 else plain
                packed = next(wide) if packed == _WIDE4 else packed
                header = next(wide) if header == _WIDE4 else header
            extra = extra[4 + length :]
        at += 46 + name_size + extra_size + note_size
        if method == 0:
            local = reader.read(header, 30)
            if local[:4] != _LOCAL:
                raise ValueError(f"no local header of {name}")
            found[name] = Member(name, header + 30 + sum(struct.unpack_from("<HH", local, 26)), plain)
    return found


def _record(row: dict) -> bytes:
    digest = row["payload_digest"]
    revisit = row["record_type"] == "revisit"
    name = lambda i: "<urn:page:>" if i is None else f"<urn:page:{i}>"
    payload = row["payload"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {name(row['page_id'])}", f"WARC-Date: {_DATE}"]
    if row["url"] is not None:
        head.append("WARC-Target-URI: " + row["url"].replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if revisit:
        head += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: {name(row['refers_to'])}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(["WARC/1.1", *head, "", ""]).encode() + block + b"\r\n\r\n"


def _headers(lines: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in lines.decode().split("\r\n")[1:] if ":" in line)
    return {k.strip().lower(): v.strip() for k, v in pairs}


def parse_record(data: bytes) -> dict:
    """The fields of one record; the digest of a response is taken from its payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/1."):
        raise ValueError("not a WARC record")
    fields = _headers(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda uri: int(n) if (n := uri.removeprefix("<urn:page:").rstrip(">")) else None
    revisit = fields["warc-type"] == "revisit"
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    if not revisit and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"the payload of {fields['warc-record-id']} does not fit its digest")
    return {
        "page_id": number(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "payload_bytes": int(_headers(http)["content-length"]) if revisit else len(payload),
        "payload_digest": digest,
        "record_type": fields["warc-type"],
        "refers_to": number(fields["warc-refers-to"]) if revisit else None,
        "payload": None if revisit else payload,
    }


class _Package:
    """One ZIP file in writing: records go out as they come, the index at the end."""

    def __init__(self, uri: str, wide: bool):
        fs, path = _open(uri)
        self.uri, self.size, self.index = uri, 0, []
        self.out = fs.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED)
        self.wide = wide
        self.member = self.zip.open(RECORDS, "w", force_zip64=wide)

    def add(self, record: bytes, page_id: int | None) -> None:
        packed = gzip.compress(record, 6, mtime=0)
        self.member.write(packed)
        self.index.append(f"{self.size} {len(packed)} {'' if page_id is None else page_id}")
        self.size += len(packed)

    def close(self) -> tuple[str, int]:
        self.member.close()
        with self.zip.open(INDEX, "w", force_zip64=self.wide) as member:
            member.write("\n".join(self.index).encode())
        self.zip.close()
        self.out.close()
        return self.uri, len(self.index)


def with_record_types(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(page_id, url, payload, payload_digest, record_type, refers_to) of each row of ``pages``."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("payload_digest"))
    long = rows.where(F.length("payload") >= min_bytes).select("page_id", "payload_digest")
    # Only digests that occur twice or more; small against the pages, and written, so its size is known.
    again = long.groupBy("payload_digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1")
    again = land(again.select("payload_digest", "first_id"), "repeated-payloads")
    joined = rows.join(again, "payload_digest", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        "page_id",
        "url",
        "payload",
        "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def write_packages(records: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES, wide: bool = False) -> DataFrame:
    """(uri, n_records) of the packages that hold ``records``, a written table; ``wide`` writes ZIP64 fields throughout."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _open(folder)
        fs.create_dir(path, recursive=True)
        package, done = None, []
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
                package = package or _Package(f"{folder}/{uuid.uuid4().hex}.zip", wide)
                package.add(_record(row), row["page_id"])
                if package.size >= package_bytes:
                    done.append(package.close())
                    package = None
        if package:
            done.append(package.close())
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())], ["uri", "n_records"])

    # Written at once: a package must not be written anew each time the list is used.
    return land(map_batches(records, run, "uri string, n_records long"), "packages")


def record_ranges(packages: DataFrame, read_bytes: int = READ_BYTES) -> DataFrame:
    """(uri, start, lengths): runs of neighbouring records of about ``read_bytes``, from the packages' indexes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("uri").to_pylist():
                reader = RangeReader(uri)
                members = stored_members(reader)
                archive, index = members[RECORDS], members[INDEX]
                starts, lengths = [], []
                next_start, free = 0, 0
                for line in reader.read(index.start, index.size).split(b"\n"):
                    if not line:
                        continue
                    offset, length = map(int, line.split(b" ")[:2])
                    if offset + length > archive.size:
                        raise ValueError(f"the index of {uri} points beyond its records")
                    if not starts or offset != next_start or free < length:
                        starts.append(archive.start + offset)
                        lengths.append([])
                        free = read_bytes
                    lengths[-1].append(length)
                    next_start, free = offset + length, free - length
                uris = pa.array([uri] * len(starts), pa.string())
                columns = [uris, pa.array(starts, pa.int64()), pa.array(lengths, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["uri", "start", "lengths"])

    # Few bytes stand for much work here, so the number of tasks follows the packages, not the bytes.
    dealt = packages.select("uri").repartition(max(1, -(-packages.count() // 8)), "uri")
    return map_batches(dealt, run, "uri string, start long, lengths array<bigint>")


_READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_records(packages: DataFrame, read_bytes: int = READ_BYTES, with_payload: bool = False) -> DataFrame:
    """The records of the packages (column ``uri``), each range by whichever task it is dealt to."""
    names = [*(f.split()[0] for f in _READ.split(", ")), *["payload"] * with_payload]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                data, at, found = RangeReader(uri).read(start, sum(lengths)), 0, []
                for length in lengths:
                    found.append(parse_record(gzip.decompress(data[at : at + length])))
                    at += length
                yield pa.RecordBatch.from_arrays([pa.array([f[n] for f in found], k) for n, k in zip(names, kinds)], names)

    ranges = land(record_ranges(packages, read_bytes), "record-ranges")
    dealt = ranges.repartition(max(1, -(-ranges.count() // 2)), "uri", "start")
    return map_batches(dealt, run, _READ + ", payload binary" * with_payload)


def archive(pages: DataFrame, folder: str | None = None, min_bytes: int = MIN_BYTES, **options) -> DataFrame:
    """Packages (uri, n_records) with a record per row of ``pages`` (page_id, url, html)."""
    folder = folder or working_folder(pages.sparkSession, "warc")
    return write_packages(with_record_types(pages, min_bytes), folder, **options)
