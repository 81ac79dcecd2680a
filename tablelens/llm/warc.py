"""WARC archives as a PySpark Python data source, and archives with identical payloads as revisits.

Reading plans file partitions (files whose gzip members carry their length are
also cut into byte ranges), takes predicates on the record type and other
header columns, inflates a record's headers first and, where a predicate fails
or the payload isn't asked for, goes on to the next record without inflating
the rest.  Writing gives every record its own gzip member with the standard's
``sl`` (skip lengths) extra field; files count only once their writer's commit
lists them, so attempts that were lost or ran twice leave nothing behind.

Cases: null payloads are empty; null page ids and urls leave their headers out
and read back as null; of equal payloads the row with the largest page_id (nulls
last) is the response, one of them if that repeats; an empty table writes an
archive without records; control characters in header values are written as
%XX; other columns are not read.  Foreign archives (plain or gzip, with or
without skip lengths) can be read too.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, WriterCommitMessage

from tablelens.llm.common import KeySet, materialise, new_folder, numbered_once

SPLIT = 64 << 20
ROLL = 256 << 20
BATCH_BYTES = 4 << 20
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = (
    "warc_type string, record_id string, target_uri string, date string, payload_digest string, refers_to string, content_type string, "
    "content_length long, http_content_length long, headers map<string,string>, payload binary"
)
#: Columns that come from one header each; predicates on them are decided before the payload is touched.
HEADERS = {"warc_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "date": "warc-date", "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to", "content_type": "content-type"}
_ARROW = pa.schema([
    *[(c, pa.string()) for c in HEADERS], ("content_length", pa.int64()), ("http_content_length", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary()),
])


# ---------------------------------------------------------------- files


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI, also of Hadoop's ``file:/x`` form."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def _files(uri: str) -> list[tuple[str, int]]:
    """(path, size) of the archives: those that commits list, or in a folder without commits all archives."""
    store, path = _open(uri)
    info = store.get_file_info(path)
    if info.type == fs.FileType.File:
        return [(path, info.size)]
    found = sorted((f for f in store.get_file_info(fs.FileSelector(path, recursive=True)) if f.type == fs.FileType.File), key=lambda f: f.path)
    lists = [f.path for f in found if f.base_name.startswith("_commit-")]
    named = {f"{path}/{n}" for x in lists for n in json.loads(store.open_input_stream(x).read())}
    return [(f.path, f.size) for f in found if (f.path in named if lists else f.base_name.endswith((".warc", ".warc.gz")))]


# ---------------------------------------------------------------- records


def _member(record: bytes) -> bytes:
    """A gzip member with skip lengths (compressed and plain size) in its extra field."""
    squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, -15)
    body = squeeze.compress(record) + squeeze.flush()
    size = 10 + 2 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, size if size < 1 << 32 else 0, len(record) & 0xFFFFFFFF)
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def _value(v: str) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in v)


def _record(row: dict) -> bytes:
    payload = row["payload"] or b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if row["record_type"] == "response" else b"")
    head = [
        ("WARC-Type", row["record_type"]), ("WARC-Record-ID", row["record_id"]), ("WARC-Target-URI", row["url"]), ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"), ("WARC-Refers-To", row["refers_to_id"]),
        ("WARC-Profile", REVISIT if row["record_type"] == "revisit" else None),
        ("X-Page-Id", row["page_id"]), ("X-Refers-To-Page-Id", row["refers_to"]),
        ("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(block)),
    ]
    lines = "".join(f"{k}: {_value(str(v))}\r\n" for k, v in head if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _parse(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name; folded lines continue the one before."""
    out: dict[str, str] = {}
    name = None
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, _, v = line.partition(":")
            name = name.strip().lower()
            out[name] = v.strip()
    return out


class _Source:
    """Bytes of a file by position, read ahead."""

    def __init__(self, store, path: str):
        self.file = store.open_input_file(path)
        self.size = self.file.size()
        self.at, self.held = 0, b""

    def get(self, pos: int, n: int) -> bytes:
        if not (self.at <= pos and pos + n <= self.at + len(self.held)):
            self.file.seek(pos)
            self.at, self.held = pos, self.file.read(max(n, 1 << 20))
        return self.held[pos - self.at : pos - self.at + n]


def _skip_lengths(head: bytes) -> int:
    """The member's compressed size from its ``sl`` field, 0 if it has none."""
    if len(head) < 12 or not head[3] & 4:
        return 0
    end = 12 + struct.unpack("<H", head[10:12])[0]
    at = 12
    while at + 4 <= min(end, len(head)):
        n = struct.unpack("<H", head[at + 2 : at + 4])[0]
        if head[at : at + 2] == b"sl" and n >= 4:
            return struct.unpack("<I", head[at + 4 : at + 8])[0]
        at += 4 + n
    return 0


def _plain_records(src: _Source, wanted, payload: bool) -> Iterator[tuple[dict, bytes | None]]:
    pos = 0
    while pos < src.size:
        n = 4096
        while (end := (got := src.get(pos, n)).find(b"\r\n\r\n")) < 0 and len(got) == n:
            n *= 4
        if end < 0:
            return
        head = _parse(got[:end])
        length = int(head.get("content-length", 0))
        body = pos + end + 4
        if wanted(head):
            yield head, src.get(body, length) if payload else src.get(body, min(length, 2048))
        pos = body + length + 4


def _gzip_records(src: _Source, begin: int, stop: int, wanted, payload: bool) -> Iterator[tuple[dict, bytes | None]]:
    pos = begin
    while pos < min(stop, src.size):
        inflate = zlib.decompressobj(31)
        size = _skip_lengths(src.get(pos, 64))
        at, out, head = pos, bytearray(), None
        while not inflate.eof and at < src.size:
            piece = src.get(at, 2048 if head is None else 1 << 18)
            at += len(piece)
            out += inflate.decompress(piece)  # grows in place
            if head is None and (end := out.find(b"\r\n\r\n")) >= 0:
                head = _parse(bytes(out[:end]))
                del out[: end + 4]
                if size and not wanted(head):
                    break
                if size and not payload and (b"\r\n\r\n" in out or inflate.eof):
                    break
            if head is not None and not payload and len(out) > 4096:
                del out[4096:]  # headers of the HTTP response only
        if head is not None and wanted(head):
            yield head, bytes(memoryview(out)[: int(head.get("content-length", 0))])
        pos = pos + size if size else at - len(inflate.unused_data)


def _sync(src: _Source, begin: int) -> int:
    """The first member with skip lengths at or after a byte position."""
    if begin == 0:
        return 0
    pos = begin
    while pos < src.size:
        got = src.get(pos, 1 << 20)
        k = got.find(b"\x1f\x8b\x08\x04")
        while k >= 0:
            if got[k + 12 : k + 14] == b"sl" or k + 14 > len(got):
                try:
                    if zlib.decompressobj(31).decompress(src.get(pos + k, 4096), 5) == b"WARC/":
                        return pos + k
                except zlib.error:
                    pass
                got = src.get(pos, 1 << 20)
            k = got.find(b"\x1f\x8b\x08\x04", k + 1)
        pos += max(1, len(got) - 3)
    return src.size


def _row(head: dict, block: bytes | None, payload: bool) -> dict:
    out = {c: head.get(h) for c, h in HEADERS.items()}
    out["content_length"] = int(head["content-length"]) if "content-length" in head else None
    out["http_content_length"], body = None, block or b""
    if head.get("content-type", "").startswith("application/http"):
        first, _, body = body.partition(b"\r\n\r\n")
        length = _parse(first).get("content-length")
        out["http_content_length"] = int(length) if length and length.isdigit() else None
    out["headers"] = list(head.items())
    out["payload"] = body if payload and head.get("warc-type") != "revisit" else None
    return out


# ---------------------------------------------------------------- data source


@dataclass
class _Range(InputPartition):
    path: str
    begin: int
    stop: int


@dataclass
class _Written(WriterCommitMessage):
    files: list


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.uri = options["path"]
        self.payload = str(options.get("payload", "true")).lower() == "true"
        kinds = options.get("types")
        #: Header name to accepted values (None: any, but there must be one).
        self.tests: list[tuple[str, frozenset | None]] = [("warc-type", frozenset(k.strip() for k in kinds.split(",")))] if kinds else []

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column not in HEADERS or not isinstance(f, EqualTo | In | IsNotNull):
                yield f
            elif isinstance(f, IsNotNull):
                self.tests.append((HEADERS[column], None))
            else:
                self.tests.append((HEADERS[column], frozenset([f.value] if isinstance(f, EqualTo) else f.value)))

    def partitions(self):
        out = []
        for path, size in _files(self.uri):
            store, _ = _open(self.uri)
            head = store.open_input_file(path).read(64) if size > SPLIT else b""
            step = SPLIT if head[:2] == b"\x1f\x8b" and _skip_lengths(head) else max(size, 1)
            out += [_Range(path, at, min(at + step, size)) for at in range(0, size, step)]
        return out or [_Range("", 0, 0)]

    def read(self, partition):
        if not partition.path:
            return
        tests = self.tests

        def wanted(head: dict) -> bool:
            return all(n in head and (ok is None or head[n] in ok) for n, ok in tests)

        store, _ = _open(self.uri)
        src = _Source(store, partition.path)
        if src.get(0, 2) == b"\x1f\x8b":
            begin = _sync(src, partition.begin)
            records = _gzip_records(src, begin, partition.stop, wanted, self.payload)
        else:
            records = _plain_records(src, wanted, self.payload)
        rows, size = [], 0
        for head, block in records:
            rows.append(_row(head, block, self.payload))
            size += 1024 + len(block or b"")
            if size >= BATCH_BYTES:
                yield pa.RecordBatch.from_pylist(rows, _ARROW)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _ARROW)


class _Writer(DataSourceArrowWriter):
    def __init__(self, options):
        self.uri = options["path"]

    def write(self, iterator):
        store, path = _open(self.uri)
        store.create_dir(path, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            for i in range(batch.num_rows):
                if out is None or size >= ROLL:
                    if out is not None:
                        out.close()
                    files.append(f"{uuid.uuid4().hex}.warc.gz")
                    out, size = store.open_output_stream(f"{path}/{files[-1]}", compression=None), 0
                member = _member(_record(batch.slice(i, 1).to_pylist()[0]))
                out.write(member)
                size += len(member)
        if out is not None:
            out.close()
        return _Written(files)

    def commit(self, messages):
        store, path = _open(self.uri)
        store.create_dir(path, recursive=True)
        with store.open_output_stream(f"{path}/_commit-{uuid.uuid4().hex}.json") as f:
            f.write(json.dumps([n for m in messages if m for n in m.files]).encode())

    def abort(self, messages):
        store, path = _open(self.uri)
        for m in messages:
            for n in m.files if m else []:
                store.delete_file(f"{path}/{n}")


class WarcDataSource(DataSource):
    """``spark.read.format("warc").load(path)``; options: types (accepted record types), payload (false: headers only)."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options)

    def writer(self, schema, overwrite):
        return _Writer(self.options)


def register(spark: SparkSession) -> None:
    """Make the format known to the session and let predicates reach it."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


# ---------------------------------------------------------------- pages


def base32_sha1(payload: Column) -> Column:
    """Upper-case base 32 of the SHA-1, in SQL functions: four times 40 bits are eight digits each."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """The rows to write: page_id, url, payload, payload_digest, record_type, refers_to (page id), record_id, refers_to_id.

    Payloads of fewer than ``least_bytes`` bytes are all responses.
    """
    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("payload_digest", base32_sha1(F.col("payload")))
    # (digest, the response's page id, rows with that id) of payloads that occur twice or more
    each = rows.filter(F.octet_length("payload") >= least_bytes).groupBy("payload_digest", "page_id").agg(F.count(F.lit(1)).alias("n"))
    twice = each.groupBy(F.col("payload_digest").alias("_d")).agg(F.sum("n").alias("n"), F.max(F.struct("page_id", F.col("n").alias("ties"))).alias("m")).filter("n > 1")
    twice = materialise(twice.select("_d", F.col("m.page_id").alias("_to"), F.col("m.ties").alias("_ties"), F.xxhash64("_d").alias("_key")), "twice")
    # all others are written straight from the scan; only rows that may have an equal are shuffled
    meant = (F.octet_length("payload") >= least_bytes) & KeySet(twice.select("_key")).column(F.xxhash64("payload_digest"))
    uuid_of = lambda *parts: F.concat(F.lit("<urn:uuid:"), F.regexp_replace(F.md5(F.concat_ws("-", *parts).cast("binary")), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))

    def written(x: DataFrame, name: str, again, known) -> DataFrame:
        """Records of rows: ``again`` where they are revisits, ``known`` where their payload has any."""
        own = uuid_of(F.lit(name), F.col("page_id").cast("string"), "payload_digest", F.monotonically_increasing_id().cast("string"))
        first = uuid_of(F.lit("first"), "payload_digest")
        return x.select(
            "page_id", "url", "payload", "payload_digest", F.when(again, "revisit").otherwise("response").alias("record_type"),
            F.when(again, F.col("_to")).alias("refers_to"), F.when(known & ~again, first).otherwise(own).alias("record_id"), F.when(again, first).alias("refers_to_id"),
        )

    never = F.lit(False)
    no_page = F.lit(None).cast(rows.schema["page_id"].dataType)
    out = written(rows.filter(~meant).withColumn("_to", no_page), "alone", never, never)
    met = rows.filter(meant).join(twice.drop("_key"), F.col("payload_digest") == F.col("_d"), "left")
    known, best = F.col("_d").isNotNull(), F.col("page_id").eqNullSafe(F.col("_to"))
    tied = known & best & (F.col("_ties") > 1)
    out = out.unionByName(written(met.filter(~tied), "met", known & ~best, known))
    if not twice.filter("_ties > 1").isEmpty():  # rows that share payload and page id are numbered: one is the response
        equal = numbered_once(met.filter(tied))
        first = equal.groupBy("_d").agg(F.min("_uid").alias("_first")).withColumnRenamed("_d", "_e")
        equal = equal.join(first, F.col("_d") == F.col("_e"))
        out = out.unionByName(written(equal, "tied", F.col("_uid") != F.col("_first"), F.lit(True)))
    return out


def write(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    register(pages.sparkSession)
    records(pages, least_bytes).write.format("warc").mode("append").save(path)


def read(spark: SparkSession, path: str, types: str | None = None, payload: bool = True) -> DataFrame:
    register(spark)
    found = spark.read.format("warc").option("payload", str(payload).lower())
    return (found.option("types", types) if types else found).load(path)


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Archive the pages, read the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A response's size and digest come from the payload that was read, a
    revisit's from its headers.
    """
    spark = pages.sparkSession
    path = new_folder(spark, "warc")
    write(pages, path, least_bytes)
    back = read(spark, path)
    own = F.col("payload").isNotNull()
    return back.select(
        F.element_at("headers", "x-page-id").cast("long").alias("page_id"),
        F.when(own, F.octet_length("payload").cast("long")).otherwise(F.col("http_content_length")).alias("payload_bytes"),
        F.when(own, base32_sha1(F.col("payload"))).otherwise(F.substring_index("payload_digest", ":", -1)).alias("payload_digest"),
        F.col("warc_type").alias("record_type"),
        F.element_at("headers", "x-refers-to-page-id").cast("long").alias("refers_to"),
    )


ORACLE = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h, max(page_id) OVER (PARTITION BY sha1(coalesce(html, ''))) AS best FROM pages),
b AS (SELECT *, list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + CAST(((('0x' || substr(h, 1 + 10 * (i // 8), 10))::BIGINT) >> (35 - 5 * (i % 8))::BIGINT) & 31 AS INTEGER), 1)) AS d FROM p)
SELECT page_id, strlen(t)::BIGINT AS payload_bytes, array_to_string(d, '') AS payload_digest,
       CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id = best THEN NULL ELSE best END AS refers_to
FROM b
"""
