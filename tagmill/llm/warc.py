"""WARC records in ZIP packages: writing, directories, indexes, and range reads without extraction."""

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
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagmill.llm.common import shared_folder, staged

# A package is closed once its records have this many bytes; reads fetch neighbouring records up to BLOCK at once.
PACKAGE_BYTES, BLOCK = 256 << 20, 4 << 20
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
STORED = 0
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
MOST_TAIL = 22 + 65535


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC 1.1 record. A revisit keeps the HTTP head, which still tells the length of the full payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    # A header is one line; line ends in a url are escaped.
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    fields = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
              f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}"]
    if revisit:
        fields += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    fields += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields (lower case), HTTP head and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode().split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, http, payload


def _page(value: str | None) -> int | None:
    number = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a uri; ``file:/x``, as Hadoop writes it, and plain paths are local to the shared mount."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = uri.removeprefix("file:")
    return pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


class _Package:
    """A ZIP package that is written as a stream: one stored WARC member, then its stored index."""

    def __init__(self, store: pafs.FileSystem, path: str):
        self.out = store.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.size, self.lines = 0, []

    def add(self, data: bytes, **entry) -> None:
        packed = gzip.compress(data, 1, mtime=0)
        self.lines.append(json.dumps(entry | {"offset": self.size, "length": len(packed)}))
        self.member.write(packed)
        self.size += len(packed)

    def close(self) -> int:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "\n".join(self.lines))
        self.zip.close()
        size = self.out.tell()
        self.out.close()
        return size


def _written(folder: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        store.create_dir(base, recursive=True)
        package, done = None, []

        def finish():
            done.append((f"{folder}/{name}", package.close(), len(package.lines)))

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("page_id", "url", "payload", "refers_to", "revisit")]
            for page_id, url, payload, refers_to, revisit in zip(*columns, strict=True):
                if package is None:
                    # No other attempt has this name; only packages of the attempt that counts are in the manifest.
                    name = f"{uuid.uuid4().hex}.zip"
                    package = _Package(store, f"{base}/{name}")
                package.add(record(page_id, url, payload or b"", refers_to, revisit), id=page_id, url=url)
                if package.size >= limit:
                    finish()
                    package = None
        if package is not None:
            finish()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=["path", "size", "records"])

    return run


def write_packages(records: DataFrame, folder: str, limit: int = PACKAGE_BYTES) -> DataFrame:
    """Write ``page_id, url, payload, refers_to, revisit`` rows and return the manifest ``path, size, records``.

    Each task writes packages of its own under fresh names, so attempts that fail
    or are repeated leave at most packages that no manifest lists.
    """
    rows = records.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "payload", "refers_to", "revisit")
    return staged(rows.mapInArrow(_written(folder, limit), "path string, size bigint, records bigint"), "manifest")


def list_packages(spark: SparkSession, folder: str) -> DataFrame:
    """``path, size`` of the packages in a folder; contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(folder).select("path", F.col("length").alias("size"))


def directory(read, size: int) -> dict[str, tuple[int, int, int, int]]:
    """Members of a ZIP file by name: method, offset of the local header, packed and full size.

    ``read(offset, length)`` fetches a range. ZIP64 ends, locators and extra fields are followed.
    """
    start = max(0, size - MOST_TAIL)
    tail = read(start, size - start)
    end = tail.rfind(b"PK\5\6")
    while end >= 0 and (len(tail) - end < 22 or struct.unpack_from("<H", tail, end + 20)[0] > len(tail) - end - 22):
        end = tail.rfind(b"PK\5\6", 0, end)
    if end < 0:
        raise ValueError("no end of a central directory")
    count, length, offset = struct.unpack_from("<HII", tail, end + 10)
    if count == 0xFFFF or length == 0xFFFFFFFF or offset == 0xFFFFFFFF:
        locator = read(start + end - 20, 20)
        if locator[:4] != b"PK\6\7":
            raise ValueError("no ZIP64 locator")
        wide = read(struct.unpack_from("<Q", locator, 8)[0], 56)
        if wide[:4] != b"PK\6\6":
            raise ValueError("no ZIP64 end of a central directory")
        count, length, offset = struct.unpack_from("<QQQ", wide, 32)
    data, at, members = read(offset, length), 0, {}
    for _ in range(count):
        if data[at:at + 4] != b"PK\1\2":
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", data, at + 8)
        packed, full = struct.unpack_from("<II", data, at + 20)
        name_size, extra_size, comment_size = struct.unpack_from("<HHH", data, at + 28)
        local = struct.unpack_from("<I", data, at + 42)[0]
        name = data[at + 46:at + 46 + name_size].decode("utf-8" if flags & 0x800 else "cp437")
        extra, i = data[at + 46 + name_size:at + 46 + name_size + extra_size], 0
        while i + 4 <= len(extra):
            kind, size_ = struct.unpack_from("<HH", extra, i)
            if kind == 1:
                # Only the fields that overflow are given, in this order.
                wide, j = [full, packed, local], i + 4
                for k in range(3):
                    if wide[k] == 0xFFFFFFFF:
                        wide[k] = struct.unpack_from("<Q", extra, j)[0]
                        j += 8
                full, packed, local = wide
            i += 4 + size_
        members[name] = (method, local, packed, full)
        at += 46 + name_size + extra_size + comment_size
    return members


def content_offset(read, local: int) -> int:
    """Where the content of a member begins, after its local header."""
    head = read(local, 30)
    if head[:4] != b"PK\3\4":
        raise ValueError("broken local header")
    name_size, extra_size = struct.unpack_from("<HH", head, 26)
    return local + 30 + name_size + extra_size


def _member(read, members: dict, name: str) -> bytes:
    method, local, packed, _ = members[name]
    data = read(content_offset(read, local), packed)
    return data if method == STORED else zlib.decompress(data, -15)


def ranges(read, size: int) -> Iterator[tuple[dict, bytes]]:
    """Index entry and packed bytes of every record, fetched by range; stored WARC members only."""
    members = directory(read, size)
    entries = [json.loads(line) for line in _member(read, members, INDEX).decode().split("\n") if line]
    method, local, _, _ = members[DATA]
    if method != STORED:
        raise ValueError("records of a compressed member cannot be read by range")
    base = content_offset(read, local)
    entries.sort(key=lambda e: e["offset"])
    at = 0
    while at < len(entries):
        first, last = at, at
        while (last + 1 < len(entries) and entries[last + 1]["offset"] == entries[last]["offset"] + entries[last]["length"]
               and entries[last + 1]["offset"] + entries[last + 1]["length"] - entries[first]["offset"] <= BLOCK):
            last += 1
        begin = entries[first]["offset"]
        block = read(base + begin, entries[last]["offset"] + entries[last]["length"] - begin)
        for entry in entries[first:last + 1]:
            yield entry, block[entry["offset"] - begin:entry["offset"] - begin + entry["length"]]
        at = last + 1


def _read(payloads: bool, rows: int = 500):
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0

        def batch_of(found):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store, place = open_store(path)
                with store.open_input_file(place) as file:
                    for entry, packed in ranges(lambda offset, length, file=file: file.read_at(length, offset), size):
                        fields, http, payload = parse_record(gzip.decompress(packed))
                        digest = fields["warc-payload-digest"].removeprefix("sha1:")
                        kind = fields["warc-type"]
                        if kind == "response":
                            length = len(payload)
                            if base32_sha1(payload) != digest:
                                raise ValueError(f"broken payload of {fields['warc-record-id']} in {path}")
                        else:
                            length = int(http.lower().split(b"content-length:")[1].split(b"\r\n")[0])
                        keep = payload if payloads and kind == "response" else None
                        out.append((_page(fields["warc-record-id"]), fields["warc-target-uri"], length, digest, kind,
                                    _page(fields.get("warc-refers-to")), keep))
                        held += len(keep or b"")
                        if len(out) >= rows or held >= BLOCK:
                            yield batch_of(out)
                            out, held = [], 0
        if out:
            yield batch_of(out)

    return run


def read_records(packages: DataFrame, payloads: bool = True) -> DataFrame:
    """Records of ``packages(path, size)``: ids, url, payload length and digest, type, ``refers_to``, payload.

    Directories and indexes are parsed where a package is read; records are
    fetched by range. Payloads of responses are checked against their digest;
    revisits have none (null).
    """
    return packages.select("path", "size").mapInArrow(
        _read(payloads), "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
                         "refers_to bigint, payload binary")


def with_revisits(pages: DataFrame, payload: Column) -> DataFrame:
    """``page_id, url, payload, refers_to, revisit``: of equal payloads the smallest page id is the response.

    Rows that repeat the smallest id are responses too; rows without an id revisit unless all of their group are.
    Digests that occur once are not joined; a digest of very many rows is split by Spark.
    """
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    first = (rows.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first"))
    joined = rows.join(first, "digest", "left")
    again = F.coalesce(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.lit(False))
    return joined.select("page_id", "url", "payload", F.when(again, F.col("first")).alias("refers_to"), again.alias("revisit"))


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write one record per row of ``pages(page_id, url, html)`` and read the packages back."""
    folder = folder or shared_folder(pages.sparkSession, "packages")
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b"").cast(T.BinaryType()))
    return read_records(write_packages(with_revisits(pages, payload), folder), payloads=False).drop("payload")


def sql() -> str:
    """The rows of ``round_trip`` computed directly, for DuckDB."""
    groups = [f"translate(to_base(('0x' || substr(h, {5 * i + 1}, 5))::BIGINT, 32, 4), '0123456789ABCDEFGHIJKLMNOPQRSTUV', "
              "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')" for i in range(8)]
    return f"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, url, strlen(html) AS payload_bytes, sha1(html) AS h, min(page_id) OVER (PARTITION BY sha1(html)) AS first FROM p)
SELECT page_id, url, payload_bytes, {' || '.join(groups)} AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM d"""
