"""Web archives packed in ZIP files: written by tasks, read by ranges.

A package is a ZIP file whose members are stored, not compressed: `archive/data.warc.gz` (one gzip member
per record), `indexes/index.cdxj` (a line per record with offset and length) and `datapackage.json`. To read
one, a task takes the end of the file, parses the central directory (and the ZIP64 one of large packages),
finds where the members lie, reads the index and cuts the records into blocks. The blocks are dealt over
the cluster, and each is read by one range request. Nothing is unpacked to disk, and a package is never held
whole, so one huge package is read by as many tasks as many small ones.

Of pages with equal payloads the one with the smallest id is written as `response`; the others are
`revisit` records, which refer to it and hold no payload. Equal payloads are found by SHA-1 and length.

Packages go to the shared folder under a name of their own for each attempt of a task, through a temporary
name, so a reader never sees a part of one. The table that writing returns lists the packages of the attempts
that counted; reading it leaves out what lost or repeated attempts left in the folder. A folder can be read, too,
for archives that come from elsewhere.

Defined results: a null page counts as empty; a null url is left out. Rows without an id are responses if no
row of their payload has one, and revisits else. If rows repeat the smallest id of a payload, all of them are
responses. Without pages there are no packages and no rows. A compressed member cannot be read by ranges
and is an error; a package without index is scanned record by record. Extra columns are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.llm.common import col, partitions, ship, stored

#: A task starts another package when one has this many bytes.
PACKAGE_BYTES = 256 << 20
#: Bytes of records read by one request.
BLOCK_BYTES = 4 << 20
ARCHIVE, INDEX = "archive/", "indexes/"
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Signatures of the ZIP format.
END, END64, LOCATOR64, ENTRY, LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"

Read = Callable[[int, int], bytes]


def page_urn(page: int | None) -> str:
    return f"urn:page:{'' if page is None else page}"


def _page_of(urn: str) -> int | None:
    number = urn.strip("<>").rpartition(":")[2]
    return int(number) if number else None


def record(page: int | None, url: str | None, payload: bytes, digest: str, first: int | None, revisit: bool) -> bytes:
    """A WARC record of a page. A revisit keeps the HTTP head, whose length is that of the full payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{page_urn(page)}>",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=''.join(map(chr, range(33, 127))).replace('%', ''))}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{page_urn(first)}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The fields of a record; the payload of a revisit is null."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode().split("\r\n")[1:])}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = [line.partition(b":")[2] for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")]
    kind = fields["warc-type"]
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    full = kind == "response"
    return {
        "page_id": _page_of(fields["warc-record-id"]),
        "url": unquote(fields["warc-target-uri"]) if "warc-target-uri" in fields else None,
        "record_type": kind,
        "payload_bytes": len(payload) if full else int(sizes[0]),
        "payload_digest": digest,
        "refers_to": _page_of(fields["warc-refers-to"]) if "warc-refers-to" in fields else None,
        "intact": not full or base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest,
        "payload": payload if full else None,
    }


class Package:
    """A package being written: records straight to the stream, the index at the end."""

    def __init__(self, place: str):
        self.place = place
        self.system, self.path = fs.FileSystem.from_uri(place)
        self.temporary = f"{self.path}.{uuid.uuid4().hex}"
        self.stream = self.system.open_output_stream(self.temporary)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(ARCHIVE + "data.warc.gz", "w", force_zip64=True)
        self.size, self.index = 0, []

    def add(self, page: int | None, url: str | None, raw: bytes, digest: str) -> None:
        squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
        packed = squeeze.compress(raw) + squeeze.flush()
        self.member.write(packed)
        about = {"url": url, "digest": f"sha1:{digest}", "length": str(len(packed)), "offset": str(self.size), "filename": "data.warc.gz"}
        self.index.append(f"{page_urn(page)} {DATE.translate(str.maketrans('', '', '-:TZ'))} {json.dumps(about)}")
        self.size += len(packed)

    def close(self) -> None:
        self.member.close()
        self.zip.writestr(INDEX + "index.cdxj", "\n".join(sorted(self.index)) + "\n")
        self.zip.writestr("datapackage.json", json.dumps({"profile": "data-package", "resources": [ARCHIVE + "data.warc.gz", INDEX + "index.cdxj"]}))
        self.zip.close()
        self.stream.close()
        self.system.move(self.temporary, self.path)


def write_packages(pages: DataFrame, folder: str, id: str = "page_id", url: str = "url", html: str = "html", revisit_from: int = 0) -> DataFrame:
    """Write the pages to packages in `folder` (on a file system the executors share); one row per package.

    Of equal payloads of at least `revisit_from` bytes all but the first are revisits.
    """
    body = F.coalesce(col(html), F.lit(""))
    rows = pages.select(
        col(id).cast("long").alias("page"), col(url).alias("url"), body.alias("html"),
        F.sha1(F.encode(body, "UTF-8")).alias("digest"), F.octet_length(body).cast("long").alias("size"),
    )
    first = rows.select("page", "digest", "size").groupBy("digest", "size").agg(F.min("page").alias("first"))
    met = rows.join(first, ["digest", "size"])
    revisit = (F.col("size") >= revisit_from) & F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))
    met = met.select("page", "url", "html", "digest", "first", revisit.alias("revisit"))
    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        package, made = None, []

        def close() -> None:
            package.close()
            made.append((package.place, len(package.index), package.size))

        for batch in batches:
            for row in zip(*[batch.column(i) for i in range(batch.num_columns)]):
                page, address, text, sha, first_page, again = (v.as_py() for v in row)
                if package is None:
                    package = Package(f"{folder.rstrip('/')}/pages-{attempt:09d}-{len(made):04d}.wacz")
                digest = base64.b32encode(bytes.fromhex(sha)).decode()
                package.add(page, address, record(page, address, text.encode(), digest, first_page, again), digest)
                if package.size >= PACKAGE_BYTES:
                    close()
                    package = None
        if package is not None:
            close()
        names = ["path", "n_records", "n_bytes"]
        yield pa.RecordBatch.from_pylist([dict(zip(names, m)) for m in made], pa.schema([("path", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())]))

    ship(pages.sparkSession)
    return stored(met.mapInArrow(write, "path string, n_records long, n_bytes long"), "packages")


def directory(read: Read, size: int) -> list[tuple[str, int, int, int]]:
    """(name, method, offset of the data, size) of every member, from the central directory."""
    tail_at = max(0, size - 22 - 65535)
    tail = read(tail_at, size - tail_at)
    at = len(tail)
    while True:
        at = tail.rfind(END, 0, at)
        if at < 0:
            raise ValueError("no ZIP directory")
        if len(tail) - at >= 22 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    if count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        locator = read(tail_at + at - 20, 20)
        if locator[:4] != LOCATOR64:
            raise ValueError("no ZIP64 locator")
        end = read(struct.unpack_from("<Q", locator, 8)[0], 56)
        if end[:4] != END64:
            raise ValueError("no ZIP64 directory")
        count, length, start = struct.unpack_from("<QQQ", end, 32)
    entries, members, p = read(start, length), [], 0
    for _ in range(count):
        if entries[p : p + 4] != ENTRY:
            raise ValueError("a broken ZIP directory")
        method, packed, full, n, extra, comment, local = struct.unpack_from("<10xH8xIIHHH8xI", entries, p)
        name = entries[p + 46 : p + 46 + n].decode()
        at, stop = p + 46 + n, p + 46 + n + extra
        while at + 4 <= stop:
            tag, width = struct.unpack_from("<HH", entries, at)
            if tag == 1:  # the 64-bit values stand in this order, each only if its field is full
                values = iter(struct.unpack_from(f"<{width // 8}Q", entries, at + 4))
                full = next(values) if full == 0xFFFFFFFF else full
                packed = next(values) if packed == 0xFFFFFFFF else packed
                local = next(values) if local == 0xFFFFFFFF else local
            at += 4 + width
        head = read(local, 30)
        if head[:4] != LOCAL:
            raise ValueError("a broken ZIP member")
        members.append((name, method, local + 30 + sum(struct.unpack_from("<HH", head, 26)), packed))
        p = stop + comment
    return members


def scan(read: Read, start: int, size: int) -> Iterator[tuple[int, int]]:
    """(offset, length) of the gzip members of an archive without index."""
    offset = at = 0
    gunzip, rest = zlib.decompressobj(31), b""
    while at < size or rest:
        if not rest:
            rest = read(start + at, min(BLOCK_BYTES, size - at))
            at += len(rest)
        gunzip.decompress(rest)
        rest = gunzip.unused_data if gunzip.eof else b""
        if gunzip.eof:
            end = at - len(rest)
            yield offset, end - offset
            offset, gunzip = end, zlib.decompressobj(31)


def locate(read: Read, size: int) -> Iterator[tuple[int, int]]:
    """(place in the file, length) of every record, in the order of their places."""
    members = directory(read, size)
    archives = {name.rpartition("/")[2]: (at, n) for name, method, at, n in members if name.startswith(ARCHIVE) and not name.endswith("/")}
    for name, method, _, _ in members:
        if method and name.startswith((ARCHIVE, INDEX)):
            raise ValueError(f"member {name} is compressed and cannot be read by ranges")
    found: list[tuple[int, int]] = []
    indexed = set()
    for name, _, at, n in members:
        if name.startswith(INDEX) and name.endswith((".cdxj", ".cdx")):
            for line in read(at, n).decode().splitlines():
                about = json.loads(line.split(" ", 2)[2])
                indexed.add(about["filename"])
                found.append((archives[about["filename"]][0] + int(about["offset"]), int(about["length"])))
    for name in sorted(archives.keys() - indexed):
        start, n = archives[name]
        found += [(start + o, k) for o, k in scan(read, start, n)]
    return iter(sorted(found))


def _reader(path: str) -> tuple[Read, int]:
    system, local = fs.FileSystem.from_uri(path)
    file = system.open_input_file(local)
    return (lambda at, n: file.read_at(n, at)), file.size()


def read_packages(spark: SparkSession, packages: DataFrame | str, payload: bool = True) -> DataFrame:
    """The records of the listed packages (column `path`), or of all packages of a folder: page_id, url, record_type, payload_bytes, payload_digest (of
    the full payload, also for revisits), refers_to, intact (the payload has that digest), package and,
    unless left out, payload."""
    if isinstance(packages, str):
        listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.wacz").load(packages).select("path")
    else:
        listed = packages.select("path").repartition(partitions(spark), "path")
    ship(spark)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("sizes", pa.list_(pa.int64()))])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                made, start, stop, sizes = [], 0, 0, []
                for at, n in locate(*_reader(path)):
                    if sizes and (at != stop or stop - start >= BLOCK_BYTES):
                        made.append({"path": path, "start": start, "stop": stop, "sizes": sizes})
                        sizes = []
                    if not sizes:
                        start = at
                    sizes.append(n)
                    stop = at + n
                if sizes:
                    made.append({"path": path, "start": start, "stop": stop, "sizes": sizes})
                yield pa.RecordBatch.from_pylist(made, schema)

    kinds = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("intact", pa.bool_())]
    kinds += [("payload", pa.binary())] if payload else []
    kinds += [("package", pa.string())]

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                read, _ = _reader(block["path"])
                data, at, rows = read(block["start"], block["stop"] - block["start"]), 0, []
                for n in block["sizes"]:
                    row = parse(zlib.decompress(data[at : at + n], 31)) | {"package": block["path"].rpartition("/")[2]}
                    rows.append({k: row[k] for k, _ in kinds})
                    at += n
                yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))

    types = {pa.int64(): "long", pa.string(): "string", pa.bool_(): "boolean", pa.binary(): "binary"}
    found = listed.mapInArrow(blocks, "path string, start long, stop long, sizes array<long>")
    dealt = found.repartition(partitions(spark), "path", "start")
    return dealt.mapInArrow(records, ", ".join(f"{k} {types[t]}" for k, t in kinds))
