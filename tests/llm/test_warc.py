import hashlib
import io
import struct
import zipfile

import pytest

from chartloom.llm import warc


@pytest.fixture
def pages(spark):
    large = "<p>é</p>" * 200
    rows = [(1, "http://a/\r\nX: y", large), (2, "http://b", large), (3, None, large), (4, "u", "small"), (5, "v", "small"), (6, "w", None), (7, "", ""), (None, "n", large), (8, "z", "x" * 300_000), (9, "q", "a\r\n\r\nb" * 300)]
    return spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, payload string").repartition(2), rows


def test_round_trip(pages, tmp_path):
    frame, rows = pages
    packages = warc.write(warc.roles(frame), f"file://{tmp_path}/out", package_bytes=500)
    assert packages.count() > 2
    got = {r.page_id: r for r in warc.read(packages).collect()}
    assert len(got) == len(rows)
    for page, _, html in rows:
        payload = (html or "").encode()
        r = got[page]
        assert r.intact
        assert (r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha1(payload).hexdigest())
        revisit = page in (1, 2, None)
        assert (r.record_type, r.refers_to) == (("revisit", 3) if revisit else ("response", None))
        assert r.payload is None if revisit else bytes(r.payload) == payload
    assert "\n" not in got[1].url


def test_without_index_and_with_a_prefix(pages, tmp_path, spark):
    frame, rows = pages
    packages = warc.write(warc.roles(frame), f"file://{tmp_path}/a").collect()
    paths = []
    for k, package in enumerate(packages):
        with zipfile.ZipFile(package.path.removeprefix("file://")) as source:
            body = source.read("archive/data.warc.gz")
        path = tmp_path / f"{k}.zip"
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as target:
            target.comment = b"PK\x05\x06 is not the end"
            target.writestr("archive/other.warc.gz", body)
        path.write_bytes(b"#!/bin/sh\n" + out.getvalue())
        paths.append((str(path),))
    read = warc.read(spark.createDataFrame(paths, "path string"), payloads=False).collect()
    assert sorted(str(r.page_id) for r in read) == sorted(str(r[0]) for r in rows)


def test_zip64_fields(tmp_path):
    """A directory whose sizes and places are in ZIP64 fields."""
    path = tmp_path / "wide.zip"
    name, body = b"archive/x", b"bytes"
    local = warc.LOCAL + struct.pack("<HHHHHIIIHH", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), 20) + name + struct.pack("<HHQQ", 1, 16, 5, 5)
    entry = warc.ENTRY + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), 28, 0, 0, 0, 0, 0xFFFFFFFF) + name + struct.pack("<HHQQQ", 1, 24, 5, 5, 0)
    at = len(local) + len(body)
    end64 = warc.END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, 1, 1, len(entry), at)
    locator = warc.LOCATOR64 + struct.pack("<IQI", 0, at + len(entry), 1)
    end = warc.END + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    path.write_bytes(local + body + entry + end64 + locator + end)
    with warc._open(str(path)) as file:
        (member,) = warc.directory(file)
        assert (member["name"], member["size"]) == ("archive/x", 5)
        assert warc._range(file, member["offset"], 5) == body


def test_empty_table(pages, tmp_path):
    packages = warc.write(warc.roles(pages[0].limit(0)), f"file://{tmp_path}/none")
    assert warc.read(packages).collect() == []
