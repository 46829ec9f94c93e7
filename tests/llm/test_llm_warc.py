"""Packages written and read back, and the ZIP directory by itself."""

import base64
import hashlib
import io
import shutil
import struct
import zipfile
import zlib

import pytest

from stockloom.llm import warc
from stockloom.session import scratch_path


def written(spark, rows, **more):
    folder = scratch_path(spark, "test-packages")
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "2 AS first")
    packages = warc.write_packages(pages, folder, **more)
    return [r.asDict() for r in warc.read_packages(spark, packages).collect()]


def test_round_trip_and_revisits(spark):
    rows = [
        (5, "http://a.example/x?y=ü&z", "<p>é</p>"), (3, "http://b.example", "<p>é</p>"), (9, None, None), (8, "u r\r\nl", ""),
        (None, "http://c", "only"), (None, "http://d", "<p>é</p>"), (1, "http://e", "\r\n\r\nWARC/1.1\r\n" * 5), (7, "http://f", "7"), (7, "http://f", "7"),
    ]
    got = written(spark, rows)
    by = {(r["page_id"], r["url"]): r for r in got}
    assert len(got) == len(rows)
    for id, url, html in rows:
        r, payload = by[id, url], (html or "").encode()
        assert r["payload_bytes"] == len(payload)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert r["intact"] and (r["payload"] is None) == (r["record_type"] == "revisit")
        assert r["payload"] is None or bytes(r["payload"]) == payload
    assert (by[3, "http://b.example"]["record_type"], by[5, rows[0][1]]["refers_to"], by[None, "http://d"]["refers_to"]) == ("response", 3, 3)
    assert by[9, None]["refers_to"] == 8 and by[None, "http://c"]["record_type"] == "response"
    assert [r["record_type"] for r in got if r["page_id"] == 7] == ["response"] * 2


def test_small_payloads_may_stay_responses(spark):
    got = written(spark, [(1, "a", "xy"), (2, "b", "xy"), (3, "c", "long enough"), (4, "d", "long enough")], revisit_from=5)
    assert {r["page_id"]: r["refers_to"] for r in got} == {1: None, 2: None, 3: None, 4: 3}


def test_packages_of_lost_attempts_are_not_read(spark):
    folder = scratch_path(spark, "test-packages")
    pages = spark.createDataFrame([(i, f"http://a/{i}", f"page {i % 3}") for i in range(6)], "page_id long, url string, html string")
    packages = warc.write_packages(pages, folder)
    path = packages.first()["path"]
    shutil.copy(path.removeprefix("file://"), path.removeprefix("file://").replace("pages-", "pages-9"))
    assert sorted(r["page_id"] for r in warc.read_packages(spark, packages).collect()) == list(range(6))
    assert warc.read_packages(spark, folder).count() > 6  # a folder is read as it lies


def test_many_packages_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(warc, "PACKAGE_BYTES", 2000)
    monkeypatch.setattr(warc, "BLOCK_BYTES", 700)
    got = written(spark, [(i, f"http://x/{i}", f"page {i} " * 40) for i in range(200)])
    assert sorted(r["page_id"] for r in got) == list(range(200))
    assert len({r["package"] for r in got}) > 3 and all(r["intact"] for r in got)


def test_no_pages(spark):
    assert written(spark, []) == []


def reader(data):
    return lambda at, n: data[at : at + n]


def packed(records):
    members = []
    for r in records:
        squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
        members.append(squeeze.compress(r) + squeeze.flush())
    return members


@pytest.mark.parametrize("limit", [1 << 31, 10])
def test_directory_with_and_without_zip64(monkeypatch, limit):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
    if limit == 10:
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for i in range(4):
            z.writestr(f"archive/{i}.warc.gz", bytes([i]) * (50 + i))
        z.comment = b"PK\5\6 in the comment"
    data = out.getvalue()
    assert (warc.END64 in data) == (limit == 10)
    for i, (name, method, at, n) in enumerate(warc.directory(reader(data), len(data))):
        assert (name, method, data[at : at + n]) == (f"archive/{i}.warc.gz", 0, bytes([i]) * (50 + i))


def test_a_directory_that_says_zip64(spark):
    """All 32-bit fields full, so that every value comes from the 64-bit records."""
    body, name = b"data", b"archive/a.warc.gz"
    local = struct.pack("<4s5H3I2H", warc.LOCAL, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), 20) + name + struct.pack("<HHQQ", 1, 16, 4, 4) + body
    extra = struct.pack("<HHQQQ", 1, 24, 4, 4, 0)
    entry = struct.pack("<4s6H3I5H2I", warc.ENTRY, 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    end64 = struct.pack("<4sQHHIIQQQQ", warc.END64, 44, 45, 45, 0, 0, 1, 1, len(entry), len(local))
    locator = struct.pack("<4sIQI", warc.LOCATOR64, 0, len(local) + len(entry), 1)
    end = struct.pack("<4s4H2IH", warc.END, 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    data = local + entry + end64 + locator + end
    ((found, _, at, n),) = warc.directory(reader(data), len(data))
    assert (found, data[at : at + n]) == (name.decode(), body)


def test_records_without_index_are_scanned(monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_BYTES", 64)
    members = packed([b"a" * 500, b"", bytes(range(256)) * 3, b"z"])
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.writestr("archive/x.warc.gz", b"".join(members))
    data = out.getvalue()
    assert [data[at : at + n] for at, n in warc.locate(reader(data), len(data))] == members


def test_compressed_members_are_refused():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("archive/x.warc.gz", b"a" * 1000)
    with pytest.raises(ValueError, match="compressed"):
        warc.locate(reader(out.getvalue()), len(out.getvalue()))
    with pytest.raises(ValueError, match="no ZIP directory"):
        warc.directory(reader(b"not a zip"), 9)
