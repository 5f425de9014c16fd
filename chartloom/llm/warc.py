"""Web archives in ZIP packages: written by Spark tasks, read back by ranges without extraction.

A package holds a stored (not compressed) WARC file, whose records are gzip members of their own, an
index with the place of each record, and a description. Reading takes the end of the package, its
central directory (with ZIP64 fields where sizes need them) and the local headers, which gives the place
of each member in the package; the index gives the place of each record in its member. Every record is then read
by its own range, and ranges of one package are spread over tasks. Packages without an index are read
member by member of the WARC file instead.

Of records with equal payloads of at least ``REVISIT_BYTES`` bytes, that with the largest page id is a
response and the others are revisits that refer to it; smaller ones are all responses. A null payload is
empty. A null page id is smaller than any other; rows with the id of the response and its payload are
responses too. Revisits carry the length and digest of the full payload in their headers.

Tasks name packages by a unique id and return what they wrote; only packages in the written list
are read, so a task that is run again leaves an unused package and no double records. Folders are
reached through ``pyarrow.fs``, so any store that it knows by URI will do.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.session import work_dir, written

REVISIT_BYTES = 1000
PACKAGE_BYTES = 128 << 20
RANGE_BYTES = 32 << 20  # of a package that are read by one task, about
TASKS = 100_000  # at most
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Fixed values of the ZIP format.
END = b"PK\x05\x06"
END64 = b"PK\x06\x06"
LOCATOR64 = b"PK\x06\x07"
ENTRY = b"PK\x01\x02"
LOCAL = b"PK\x03\x04"
EXTRA64 = 1


# Roles


def roles(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, payload, payload_digest, refers_to``: which pages are revisits, and of what."""
    base = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.encode(F.coalesce(F.col(html).cast("string"), F.lit("")), "UTF-8").alias("payload")
    ).withColumns({"payload_digest": F.sha1("payload"), "payload_bytes": F.octet_length("payload").cast("long")})
    large = base.where(F.col("payload_bytes") >= REVISIT_BYTES)
    kept = large.groupBy("payload_digest", "payload_bytes").agg(F.max("page_id").alias("kept"), F.count("*").alias("n")).where("n > 1").drop("n")
    joined = base.join(kept, ["payload_digest", "payload_bytes"], "left")
    return joined.select("page_id", "url", "payload", "payload_digest", F.when(~F.col("kept").eqNullSafe(F.col("page_id")), F.col("kept")).alias("refers_to"))


# Writing


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A WARC record, not yet compressed."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = head if refers_to is not None else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'null' if page is None else page}>",
        f"WARC-Date: {DATE}",
        *([] if url is None else [f"WARC-Target-URI: {_one_line(url)}"]),
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        *([] if refers_to is None else [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]),
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _one_line(url: str) -> str:
    """Control characters would end a header."""
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


class Package:
    """One package that is being written: records first, then their index."""

    def __init__(self, root: str):
        system, folder = fs.FileSystem.from_uri(root)
        system.create_dir(folder, recursive=True)
        name = f"{uuid.uuid4().hex}.wacz"
        self.path = f"{root}/{name}"
        self.stream = system.open_output_stream(f"{folder}/{name}")
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED)
        self.warc = self.zip.open("archive/data.warc.gz", "w", force_zip64=True)
        self.size = 0
        self.index: list[dict] = []

    def add(self, page, url, payload, digest, refers_to) -> None:
        packed = gzip.compress(record(page, url, payload, digest, refers_to), 6, mtime=0)
        self.index.append({"url": url, "offset": self.size, "length": len(packed), "filename": "data.warc.gz"})
        self.warc.write(packed)
        self.size += len(packed)

    def close(self) -> tuple[str, int, int]:
        self.warc.close()
        lines = sorted(f"{_one_line(entry['url'] or '-').replace(' ', '%20')} {DATE[:10].replace('-', '')}000000 {json.dumps(entry)}" for entry in self.index)
        self.zip.writestr("indexes/index.cdxj", "\n".join(lines))
        self.zip.writestr("datapackage.json", json.dumps({"profile": "data-package", "wacz_version": "1.1.1", "resources": [{"path": "archive/data.warc.gz", "bytes": self.size}, {"path": "indexes/index.cdxj"}]}))
        self.zip.close()
        self.stream.close()
        return self.path, len(self.index), self.size


def write(records: DataFrame, root: str | None = None, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Packages of the rows of ``roles``, written now: ``path, records, bytes`` of each."""
    root = root or work_dir(records.sparkSession, "packages")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, done = None, []
        for batch in batches:
            for k in range(batch.num_rows):
                row = [batch.column(c)[k].as_py() for c in ("page_id", "url", "payload", "payload_digest", "refers_to")]
                package = package or Package(root)
                package.add(*row)
                if package.size >= package_bytes:
                    done.append(package.close())
                    package = None
        if package:
            done.append(package.close())
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), *(pa.array([d[c] for d in done], pa.int64()) for c in (1, 2))], ["path", "records", "bytes"])

    return written(records.select("page_id", "url", "payload", "payload_digest", "refers_to").mapInArrow(run, "path string, records long, bytes long"), "packages")


# Reading


def directory(file) -> list[dict]:
    """Members of a package: name, method, sizes, and where their bytes begin."""
    total = file.size()
    tail_at = max(0, total - (1 << 16) - 22)
    tail = _range(file, tail_at, total - tail_at)
    at = len(tail) - 22
    while at >= 0 and not (tail[at : at + 4] == END and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail)):
        at = tail.rfind(END, 0, at + 3) if at > 0 else -1
    if at < 0:
        raise ValueError("no end of a central directory")
    count, size, offset = struct.unpack_from("<HII", tail, at + 10)
    end = tail_at + at
    if at >= 20 and tail[at - 20 : at - 16] == LOCATOR64:
        place = struct.unpack_from("<Q", tail, at - 12)[0]
        wide = _range(file, place, 56)
        if wide[:4] != END64:
            raise ValueError("no ZIP64 end of a central directory")
        count, size, offset = struct.unpack_from("<QQQ", wide, 32)
        end = place
    before = end - size - offset  # bytes in front of the package, if it was appended to something
    listing = _range(file, offset + before, size)
    members, at = [], 0
    for _ in range(count):
        if listing[at : at + 4] != ENTRY:
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", listing, at + 8)
        packed, plain = struct.unpack_from("<II", listing, at + 20)
        name_size, extra_size, comment_size = struct.unpack_from("<HHH", listing, at + 28)
        local = struct.unpack_from("<I", listing, at + 42)[0]
        name = listing[at + 46 : at + 46 + name_size].decode("utf-8" if flags & 0x800 else "cp437")
        extra = listing[at + 46 + name_size : at + 46 + name_size + extra_size]
        plain, packed, local = _wide(extra, plain, packed, local)
        head = _range(file, local + before, 30)
        if head[:4] != LOCAL:
            raise ValueError(f"no local header of {name}")
        members.append({"name": name, "method": method, "size": packed, "plain": plain, "offset": local + before + 30 + sum(struct.unpack_from("<HH", head, 26))})
        at += 46 + name_size + extra_size + comment_size
    return members


def _wide(extra: bytes, *fields: int) -> list[int]:
    """Fields whose 32 bits are all set are in the ZIP64 extra field, in this order."""
    at, out = 0, list(fields)
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == EXTRA64:
            inner = at + 4
            for k, field in enumerate(fields):
                if field == 0xFFFFFFFF:
                    out[k] = struct.unpack_from("<Q", extra, inner)[0]
                    inner += 8
        at += 4 + size
    return out


def _range(file, offset: int, size: int) -> bytes:
    file.seek(offset)
    return file.read(size)


def _open(path: str):
    system, name = fs.FileSystem.from_uri(path)
    return system.open_input_file(name)


def _ranges(file) -> Iterator[tuple[int, int]]:
    """Offset in the package and length of each record."""
    members = directory(file)
    archives = {m["name"]: m for m in members if m["name"].startswith("archive/")}
    for member in archives.values():
        if member["method"] != 0:
            raise ValueError(f"{member['name']} is compressed in its package")
    indexed = set()
    for member in members:
        if member["name"].startswith("indexes/") and member["name"].endswith((".cdxj", ".cdx")) and member["method"] == 0:
            for line in _range(file, member["offset"], member["size"]).decode().splitlines():
                entry = json.loads(line[line.index("{") :])
                name = f"archive/{entry['filename']}"
                indexed.add(name)
                yield archives[name]["offset"] + int(entry["offset"]), int(entry["length"])
    for name, member in archives.items():
        if name not in indexed:
            yield from _scan(file, member["offset"], member["size"])


def _scan(file, offset: int, size: int, step: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Gzip members one after another."""
    begin, at, unpack = offset, offset, zlib.decompressobj(31)
    while at < offset + size:
        chunk = _range(file, at, min(step, offset + size - at))
        at += len(chunk)
        while chunk:
            unpack.decompress(chunk)
            if not unpack.eof:
                break
            chunk = unpack.unused_data
            yield begin, at - len(chunk) - begin
            begin, unpack = at - len(chunk), zlib.decompressobj(31)


def parse(packed: bytes) -> dict:
    """Headers and payload of a compressed record."""
    raw = gzip.decompress(packed)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    answer = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    number = lambda name: None if (v := fields[name][len("<urn:page:") : -1]) == "null" else int(v)
    revisit = fields["WARC-Type"] == "revisit"
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    return {
        "page_id": number("WARC-Record-ID"),
        "url": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"],
        "refers_to": number("WARC-Refers-To") if revisit else None,
        "payload_bytes": int(answer["Content-Length"]) if revisit else len(payload),
        "payload_digest": digest if revisit else hashlib.sha1(payload).hexdigest(),
        "intact": revisit or hashlib.sha1(payload).hexdigest() == digest,
        "payload": None if revisit else payload,
    }


_FIELDS = {
    "page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(),
    "payload_bytes": pa.int64(), "payload_digest": pa.string(), "intact": pa.bool_(), "payload": pa.binary(),
}


def read(packages: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the packages at ``path``: page, type, length and digest of the full payload, and the payload itself.

    ``intact`` says whether the digest of a response's payload is that in its header.
    """

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with _open(path) as file:
                    found = list(_ranges(file))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(found), pa.string()), *(pa.array([f[c] for f in found], pa.int64()) for c in (0, 1))], ["path", "offset", "length"]
                )

    names = [n for n in _FIELDS if payloads or n != "payload"]

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, file = None, None
        rows: list[dict] = []
        held = 0
        for batch in batches:
            for own, offset, length in zip(*[batch.column(c).to_pylist() for c in ("path", "offset", "length")], strict=True):
                if own != path:
                    if file:
                        file.close()
                    path, file = own, _open(own)
                rows.append(parse(_range(file, offset, length)))
                held += length
                if held > 1 << 20 or len(rows) >= 2000:
                    yield _rows(rows, names)
                    rows, held = [], 0
        if file:
            file.close()
        yield _rows(rows, names)

    kinds = {pa.int64(): "long", pa.string(): "string", pa.bool_(): "boolean", pa.binary(): "binary"}
    ranges = packages.select("path").mapInArrow(places, "path string, offset long, length long")
    # Rows are narrow and what they stand for is not, so their number is not left to the size of the rows.
    total = packages.agg(F.sum("bytes")).first()[0] if "bytes" in packages.columns else None
    tasks = min(TASKS, max(packages.sparkSession.sparkContext.defaultParallelism, (total or 0) // RANGE_BYTES))
    spread = ranges.withColumn("block", F.expr(f"offset div {RANGE_BYTES // 8}")).repartition(tasks, "path", "block").sortWithinPartitions("path", "offset")
    return spread.mapInArrow(records, ", ".join(f"{n} {kinds[_FIELDS[n]]}" for n in names))


def _rows(rows: list[dict], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], _FIELDS[n]) for n in names], names)
