"""Packages: exact round trips, ZIP64 directories, and records read by ranges."""

import hashlib
import io
import struct
import zipfile

import pytest

from newsflow.llm import warc

BIG = "é" * 600
ROWS = [
    (1, "http://a/1", BIG), (5, "http://a/5", BIG), (3, None, BIG), (2, "u", "small"), (4, "u", "small"),
    (6, "u\r\nX: y", None), (7, "u", ""), (8, "u", "x" * 999), (9, "u", "x" * 999), (10, "u", "x" * 1000),
    (11, "u", "x" * 1000), (11, "u", "x" * 1000), (None, "u", "x" * 1000), (None, None, None),
    (12, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 100),
]


def expected(rows, least=1000):
    last = {}
    for i, _, html in rows:
        last[html or ""] = max(filter(lambda x: x is not None, (last.get(html or ""), i)), default=None)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        revisit = len(data) >= least and last[html or ""] is not None and i != last[html or ""]
        name = f"urn:page:{'' if i is None else i}"
        refers = f"urn:page:{last[html or '']}" if revisit else None
        out.append((name, "revisit" if revisit else "response", refers, len(data), hashlib.sha1(data).hexdigest(),
                    None if revisit else data))
    return sorted(out, key=str)


@pytest.mark.parametrize(("package", "block"), [(10**7, 10**6), (1, 1), (600, 700)])
def test_round_trip(spark, package, block):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").selectExpr("*", "1 AS payload", "2 AS id")
    manifest = warc.write_packages(pages, package_bytes=package)
    out = warc.read_packages(manifest, block_bytes=block).collect()
    got = [(r.record_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest,
            None if r.payload is None else bytes(r.payload)) for r in out]
    assert sorted(got, key=str) == expected(ROWS)
    assert all(r.payload is None or hashlib.sha1(r.payload).hexdigest() == r.payload_digest for r in out)


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_packages(warc.write_packages(pages)).count() == 0


def sample(n=5):
    rows = [dict(payload=b"p%d" % i * 50, payload_bytes=100, record_type="response", record_id=f"urn:page:{i}",
                 url="u", payload_digest=hashlib.sha1(b"p%d" % i * 50).hexdigest(), refers_to=None) for i in range(n)]
    return [warc.record(r) for r in rows]


def places(records):
    at, out = 0, []
    for r in records:
        out.append({"offset": at, "length": len(r)})
        at += len(r)
    return out


def read_all(path):
    with warc.Package(str(path)) as package:
        return [warc.parsed(package.read(*place))["record_id"] for place in package.entries()]


def test_zip64(tmp_path, monkeypatch):
    # With tiny limits the standard writer makes ZIP64 fields, record and locator.
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 40)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    records = sample()
    warc.write_package(str(tmp_path / "a.wacz"), records, places(records))
    raw = (tmp_path / "a.wacz").read_bytes()
    assert warc.END64 in raw and struct.pack("<HH", 1, 16) in raw or struct.pack("<HH", 1, 24) in raw
    assert read_all(tmp_path / "a.wacz") == [f"urn:page:{i}" for i in range(5)]


def test_scan_comment_and_compressed_members(tmp_path):
    records = sample()
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("pages/pages.jsonl", "x" * 500, zipfile.ZIP_DEFLATED)
        z.writestr(warc.DATA_MEMBER, b"".join(records))
        z.comment = b"a comment PK\5\6 that looks like an end"
    (tmp_path / "a.wacz").write_bytes(buffer.getvalue())
    assert read_all(tmp_path / "a.wacz") == [f"urn:page:{i}" for i in range(5)]
    with warc.Package(str(tmp_path / "a.wacz")) as package:
        assert set(package.members()) == {warc.DATA_MEMBER}


def test_broken(tmp_path):
    (tmp_path / "a.wacz").write_bytes(b"no package")
    with pytest.raises(ValueError, match="central directory"):
        read_all(tmp_path / "a.wacz")
