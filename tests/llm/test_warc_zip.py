"""Archives written and read back, and the ZIP directory by hand."""

import base64
import hashlib
import io
import os
import struct
import zipfile

import pytest

from inkledger.llm import warc_zip
from inkledger.llm.warc_zip import Member, members, parsed_records, read_packages, write_packages

PAGES = "page_id bigint, url string, html string"


def round_trip(spark, tmp_path, rows, **more):
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    manifest = write_packages(pages, str(tmp_path / "packages"), **more)
    return read_packages(manifest), manifest


def test_every_record_comes_back(spark, tmp_path):
    rows = [(i, f"http://h/{i}", "x" * (i * 37 % 500)) for i in range(300)] + [
        (1000, None, None), (1001, "", ""), (1002, "http://a b/\r\nWARC-Type: fake", "é漢\r\n\r\nWARC/1.1\r\n"), (1003, "u", "é漢\r\n\r\nWARC/1.1\r\n"),
        (1003, "u", "é漢\r\n\r\nWARC/1.1\r\n"), (None, "n", "lonely"), (None, "n", "é漢\r\n\r\nWARC/1.1\r\n"), (2000, "long", "z" * 3_000_000)]
    records, manifest = round_trip(spark, tmp_path, rows)
    got = records.collect()
    assert len(got) == len(rows) == sum(r["records"] for r in manifest.collect())
    largest = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if i is not None:
            largest[data] = max(largest.get(data, i), i)
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        revisit = data in largest and largest[data] != i and sum((h or "").encode() == data for _, _, h in rows) > 1
        want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response",
                     largest[data] if revisit else None, None if revisit else data))
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    assert sorted((tuple(r[n] if n != "payload" or r[n] is None else bytes(r[n]) for n in names) for r in got), key=str) == sorted(want, key=str)


def test_small_payloads_and_empty_table(spark, tmp_path):
    records, _ = round_trip(spark, tmp_path, [(1, "a", "xy"), (2, "b", "xy"), (3, "c", "long one"), (4, "d", "long one")], min_bytes=5)
    assert {r["page_id"]: r["record_type"] for r in records.collect()} == {1: "response", 2: "response", 3: "revisit", 4: "response"}
    empty, manifest = round_trip(spark, tmp_path / "none", [])
    assert empty.count() == 0 and manifest.count() == 0


def test_packages_roll_and_blocks_are_cut(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc_zip, "RECORDS", 10)
    monkeypatch.setattr(warc_zip, "BLOCK", 1000)
    records, manifest = round_trip(spark, tmp_path, [(i, "u", f"{i}" * 100) for i in range(95)])
    assert manifest.count() >= 10 and manifest.filter("records > 10").count() == 0
    assert sorted(r["page_id"] for r in records.collect()) == list(range(95))


class Counted(io.BytesIO):
    """Counts the bytes read."""

    total = 0

    def read(self, n=-1):
        data = super().read(n)
        self.total += len(data)
        return data


def test_directory_is_read_without_the_members():
    store = io.BytesIO()
    with zipfile.ZipFile(store, "w") as z:
        z.writestr("archive/data.warc", os.urandom(3_000_000))
        z.writestr("indexes/index.cdxj", b"{}")
        z.writestr(zipfile.ZipInfo("deflated"), b"a" * 1000, zipfile.ZIP_DEFLATED)
        z.comment = b"a comment with PK\x05\x06 in it, and more than twenty-two bytes after"
    file = Counted(store.getvalue())
    found = {m.name: m for m in members(file)}
    assert found["indexes/index.cdxj"].size == 2 and found["deflated"].method == 8 and file.total < 70_000
    place = found["indexes/index.cdxj"]
    assert store.getvalue()[place.start:place.start + place.size] == b"{}"


def test_more_members_than_fit_in_16_bits():
    store = io.BytesIO()
    with zipfile.ZipFile(store, "w") as z:
        for i in range(66_000):
            z.writestr(zipfile.ZipInfo(f"{i}"), b"")
    assert b"PK\x06\x06" in store.getvalue() and len(members(io.BytesIO(store.getvalue()))) == 66_000


def test_wide_sizes_and_offsets():
    """All 32-bit fields say to look in the ZIP64 ones, as a package beyond 4 GB has it."""
    data, name, ones = b"hello", b"archive/data.warc", 0xFFFFFFFF
    local = struct.pack("<4sHHHHHIIIHH", b"PK\x03\x04", 45, 0, 0, 0, 0, 0, ones, ones, len(name), 20) + name + struct.pack("<HHQQ", 1, 16, 5, 5)
    extra = struct.pack("<HH2s", 0x9999, 2, b"xx") + struct.pack("<HHQQQ", 1, 24, 5, 5, 0)
    entry = struct.pack("<4sHHHHHHIIIHHHHHII", b"PK\x01\x02", 45, 45, 0, 0, 0, 0, 0, ones, ones, len(name), len(extra), 0, 0, 0, 0, ones) + name + extra
    at = len(local) + len(data)
    wide = struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, 1, 1, len(entry), at)
    locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, at + len(entry), 1)
    end = struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, ones, ones, 0)
    assert members(io.BytesIO(local + data + entry + wide + locator + end)) == [Member("archive/data.warc", 0, len(local), 5)]


def test_plain_and_packed_records_are_read():
    import gzip

    import zstandard

    records = [warc_zip.record_bytes(i, "u", b"payload", None, False) for i in range(3)]
    packer = zstandard.ZstdCompressor()
    forms = [b"".join(records), b"".join(gzip.compress(r) for r in records), b"".join(packer.compress(r) for r in records)]
    assert [[body for _, body in parsed_records(f)] for f in forms] == [[body for _, body in parsed_records(forms[0])]] * 3


def test_cut_packages_and_wrong_digests_are_errors(spark, tmp_path):
    with pytest.raises(ValueError, match="cut short"):
        members(io.BytesIO(b"PK\x03\x04" + b"x" * 100))
    with pytest.raises(ValueError):
        list(parsed_records(b"not a record\r\n\r\n"))
    record = warc_zip.record_bytes(1, "u", b"payload", None, False)
    with pytest.raises(ValueError, match="digest"):
        list(warc_zip._rows(record.replace(b"payload\r\n\r\n", b"PAYLOAD\r\n\r\n")))


def test_extra_columns_do_not_matter(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "h", "x", 2)], PAGES + ", payload string, digest int")
    assert read_packages(write_packages(pages, str(tmp_path / "p"))).first()["payload_bytes"] == 1
