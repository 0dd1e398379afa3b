"""WARC records in ZIP packages: written as stored members with an index, read by ranges.

A package holds `archive/data.warc.gz`, one gzip member per record, and `indexes/index.cdxj`, both
stored. The reader takes the end record, the ZIP64 records and the central directory from the tail
of the file, then reads index and records by their ranges; nothing is unpacked to disk.
Packages live in a folder that driver and executors share (any file system that Arrow opens by URI).
"""

from __future__ import annotations

import base64
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import new_folder, stored, utf8

DATA_MEMBER = "archive/data.warc.gz"
INDEX_MEMBER = "indexes/index.cdxj"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PACKAGE_BYTES = 16 * 2**20
BLOCK_BYTES = 2 * 2**20
CHUNK = 2**20
END, END64, LOCATOR64, ENTRY, LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"


def plain(value: str) -> str:
    """A header value on one line."""
    return " ".join(value.split())


def hex_to_label(digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()


def label_to_hex(label: str) -> str:
    return base64.b32decode(label.removeprefix("sha1:")).hex()


def record(row: dict) -> bytes:
    """One gzip member: the WARC headers, the HTTP headers and, for a response, the payload."""
    payload = row["payload"] or b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n"
    block = http.encode() + (payload if row["record_type"] == "response" else b"")
    headers = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": f"<{row['record_id']}>",
        "WARC-Target-URI": plain(row["url"] or ""),
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Payload-Digest": hex_to_label(row["payload_digest"]),
        "Content-Type": "application/http; msgtype=response",
    }
    if row["record_type"] == "revisit":
        headers |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": f"<{row['refers_to']}>"}
    headers["Content-Length"] = str(len(block))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers.items() if v) + "\r\n"
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def parsed(data: bytes) -> dict:
    """The record of one gzip member."""
    raw = zlib.decompress(data, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record at this place")
    headers = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    block = rest[: int(headers["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    lengths = [x.partition(b":")[2] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    label = headers.get("warc-payload-digest")
    return {
        "record_type": headers.get("warc-type"),
        "record_id": headers.get("warc-record-id", "").strip("<>"),
        "url": headers.get("warc-target-uri"),
        "refers_to": headers["warc-refers-to"].strip("<>") if "warc-refers-to" in headers else None,
        "payload_digest": label_to_hex(label) if label else None,
        "payload_bytes": int(lengths[0]) if lengths else len(payload),
        "payload": payload if headers.get("warc-type") == "response" else None,
    }


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write_package(uri: str, records: list[bytes], entries: list[dict]) -> None:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_STORED, allowZip64=True) as package:
        package.writestr(zipfile.ZipInfo(DATA_MEMBER), b"".join(records))
        lines = "".join(json.dumps(e, sort_keys=True) + "\n" for e in entries)
        package.writestr(zipfile.ZipInfo(INDEX_MEMBER), lines)
    system, path = file_system(uri)
    with system.open_output_stream(path) as out:
        out.write(buffer.getbuffer())


@dataclass
class Member:
    name: str
    start: int
    size: int


class Package:
    """Range access to the stored members of a ZIP file."""

    def __init__(self, uri: str):
        system, path = file_system(uri)
        self.file = system.open_input_file(path)
        self.size = self.file.size()

    def __enter__(self) -> Package:
        return self

    def __exit__(self, *_: object) -> None:
        self.file.close()

    def read(self, start: int, size: int) -> bytes:
        return self.file.read_at(size, start)

    def directory(self) -> tuple[int, int, int]:
        """Start and size of the central directory, and how many entries it has."""
        tail_at = max(0, self.size - 22 - 65535)
        tail = self.read(tail_at, self.size - tail_at)
        at = tail.rfind(END)
        while at >= 0 and struct.unpack_from("<H", tail, at + 20)[0] != len(tail) - at - 22:
            at = tail.rfind(END, 0, at)
        if at < 0:
            raise ValueError("no end of a central directory")
        entries, size, start = struct.unpack_from("<HII", tail, at + 10)
        end_at = tail_at + at
        if end_at >= 20 and (locator := self.read(end_at - 20, 20))[:4] == LOCATOR64:
            record64 = self.read(struct.unpack_from("<Q", locator, 8)[0], 56)
            if record64[:4] != END64:
                raise ValueError("the ZIP64 record is not where its locator says")
            entries, size, start = struct.unpack_from("<QQQ", record64, 32)
        return start, size, entries

    def members(self) -> dict[str, Member]:
        """The stored members by name; compressed ones can't be read by ranges and are left out."""
        start, size, entries = self.directory()
        raw, at, out = self.read(start, size), 0, {}
        for _ in range(entries):
            if raw[at : at + 4] != ENTRY:
                raise ValueError("the central directory is broken")
            method, packed, whole = struct.unpack_from("<H8xII", raw, at + 10)
            n_name, n_extra, n_comment = struct.unpack_from("<HHH", raw, at + 28)
            offset = struct.unpack_from("<I", raw, at + 42)[0]
            name = raw[at + 46 : at + 46 + n_name].decode("utf-8", "replace")
            extra = raw[at + 46 + n_name : at + 46 + n_name + n_extra]
            at += 46 + n_name + n_extra + n_comment
            if method == 0:
                _, packed, offset = wide(extra, whole, packed, offset)
                out[name] = Member(name, offset, packed)
        for member in out.values():
            head = self.read(member.start, 30)
            if head[:4] != LOCAL:
                raise ValueError(f"{member.name} is not where the directory says")
            member.start += 30 + sum(struct.unpack_from("<HH", head, 26))
        return out

    def lines(self, member: Member) -> Iterator[bytes]:
        rest = b""
        for at in range(0, member.size, CHUNK):
            *whole, rest = (rest + self.read(member.start + at, min(CHUNK, member.size - at))).split(b"\n")
            yield from whole
        if rest:
            yield rest

    def scanned(self, member: Member) -> Iterator[tuple[int, int]]:
        """Offset and length of each gzip member, found by reading through it."""
        at, begin, unpack = 0, 0, zlib.decompressobj(31)
        while at < member.size:
            data = self.read(member.start + at, min(CHUNK, member.size - at))
            at += len(data)
            while data:
                unpack.decompress(data)
                if not unpack.eof:
                    break
                data = unpack.unused_data
                end = at - len(data)
                yield begin, end - begin
                begin, unpack = end, zlib.decompressobj(31)

    def entries(self) -> Iterator[tuple[int, int]]:
        """Places of all records in the file: from the index, or by a scan where there is none."""
        members = self.members()
        data = members.get(DATA_MEMBER)
        if data is None:
            return
        if index := members.get(INDEX_MEMBER):
            places = ((e["offset"], e["length"]) for e in map(json.loads, filter(None, self.lines(index))))
        else:
            places = self.scanned(data)
        for offset, length in places:
            yield data.start + offset, length


def wide(extra: bytes, whole: int, packed: int, offset: int) -> tuple[int, int, int]:
    """The three numbers of an entry, from its ZIP64 field where they do not fit into 32 bits."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            values = iter(struct.unpack_from(f"<{size // 8}Q", extra, at + 4))
            whole, packed, offset = (next(values) if x == 0xFFFFFFFF else x for x in (whole, packed, offset))
        at += 4 + size
    return whole, packed, offset


def deduplicated(pages: DataFrame, id_col: str, url_col: str, html_col: str, least: int) -> DataFrame:
    """Records to write: of equal payloads of at least `least` bytes, those that do not have the
    largest id are revisits without payload.

    Only a digest and an id per distinct payload are grouped. Smaller payloads get keys of their own,
    so that they are dealt evenly in the join.
    """
    payload = F.encode(utf8(html_col), "UTF-8")
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload).alias("payload_digest"),
        F.when(F.octet_length(payload) >= least, F.sha2(payload, 256)).alias("same"),
    )
    first = rows.where("same IS NOT NULL").groupBy("same").agg(F.max("id").alias("response"))
    own = F.concat(F.lit("-"), F.xxhash64("id", "url", "payload_digest").cast("string"))
    joined = rows.withColumn("same", F.coalesce("same", own)).join(first, "same", "left")
    revisit = F.col("response").isNotNull() & ~F.col("id").eqNullSafe(F.col("response"))
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")))
    return joined.select(
        name("id").alias("record_id"), "url", "payload_bytes", "payload_digest",
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(revisit, name("response")).alias("refers_to"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write_packages(
    pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
    html_col: str = "html", least: int = 1000, package_bytes: int = PACKAGE_BYTES,
) -> DataFrame:
    """Write one record per page; returns the stored manifest: `package string, n_records long`.

    A null html is an empty payload, a null id an empty name. Of equal payloads from `least` bytes on,
    the rows with the largest id are responses (rows that repeat that id as well), the others
    revisits; without any id all are responses. A task writes packages under fresh names, and only the
    manifest of tasks that ended well counts, so a task that is run again leaves no second copy in it.
    An empty table gives an empty manifest. Other columns are not read.
    """
    target = folder or new_folder(pages.sparkSession, "warc")
    system, path = file_system(target)
    system.create_dir(path, recursive=True)
    rows = deduplicated(pages, id_col, url_col, html_col, least)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records: list[bytes] = []
        entries: list[dict] = []
        size = 0

        def close() -> pa.RecordBatch:
            uri = f"{target}/{uuid.uuid4().hex}.wacz"
            write_package(uri, records, entries)
            return pa.record_batch([pa.array([uri]), pa.array([len(records)], pa.int64())], names=["package", "n_records"])

        for batch in batches:
            for row in batch.to_pylist():
                data = record(row)
                entries.append({"offset": size, "length": len(data), "type": row["record_type"], "url": row["url"]})
                records.append(data)
                size += len(data)
                if size >= package_bytes:
                    yield close()
                    records, entries, size = [], [], 0
        if records:
            yield close()

    return stored(rows.mapInArrow(write, "package string, n_records long"), "warc-manifest")


RECORD_FIELDS = (
    "record_type string, record_id string, url string, refers_to string, payload_digest string, "
    "payload_bytes long, payload binary"
)


def read_packages(manifest: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All records of the packages named in the column `package`: RECORD_FIELDS.

    One pass reads directories and indexes and makes blocks of neighbouring records; the blocks are
    dealt out and read by their ranges, so one large package is read by many tasks. payload is null
    for revisits, whose digest and length come from their headers. A package named twice is read
    twice; an empty manifest gives no rows; a broken package is an error that names it.
    """

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                held, size = [], 0
                with Package(uri) as package:
                    for place in package.entries():
                        if held and size + place[1] > block_bytes:
                            yield block(uri, held)
                            held, size = [], 0
                        held.append(place)
                        size += place[1]
                if held:
                    yield block(uri, held)

    def block(uri: str, places: list[tuple[int, int]]) -> pa.RecordBatch:
        begin = places[0][0]
        starts = [at - begin for at, _ in places]
        return pa.record_batch(
            [pa.array([uri]), pa.array([begin], pa.int64()), pa.array([starts], pa.list_(pa.int64())),
             pa.array([[n for _, n in places]], pa.list_(pa.int64()))],
            names=["package", "begin", "starts", "lengths"],
        )

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            *[(n, pa.string()) for n in ("record_type", "record_id", "url", "refers_to", "payload_digest")],
            ("payload_bytes", pa.int64()), ("payload", pa.binary()),
        ])
        for batch in batches:
            for row in batch.to_pylist():
                with Package(row["package"]) as package:
                    end = max(s + n for s, n in zip(row["starts"], row["lengths"]))
                    data = package.read(row["begin"], end)
                found = [parsed(data[s : s + n]) for s, n in zip(row["starts"], row["lengths"])]
                for at in range(0, len(found), 200):
                    yield pa.RecordBatch.from_pylist(found[at : at + 200], schema=schema)

    places = manifest.select("package").mapInArrow(
        blocks, "package string, begin long, starts array<long>, lengths array<long>"
    )
    dealt = places.repartition(F.col("package"), F.col("begin"))
    return dealt.mapInArrow(read, RECORD_FIELDS)
