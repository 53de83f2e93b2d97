"""Operator 8, WARC: a Python data source that writes and reads web archives.

Writing: one file a task, ``part-NNNNN-<attempt>.warc.gz``, a gzip member a record. A member's header has the
field ``sl`` with the length of its compressed data, so that a reader steps over it without inflating it. An
index of member offsets lies beside each file; each write leaves a ``_manifest-<id>`` that names the files of its attempts that were
committed, so files of lost executors are never read. A path holds the records of all writes to it; a write in overwrite mode
leaves its own only.

Reading: files are planned into partitions of about ``split`` bytes along the indexes. Filters on record_type,
record_id, target_uri and refers_to are pushed into the reader, which parses a record's headers first and only
then inflates the payload: never for records that a filter refuses, nor at all with option ``payload=false``.

Columns of the source: record_id, record_type, target_uri, refers_to, payload_digest (bare upper-case base32
SHA-1), payload_length, payload (null of a revisit), digest_ok (null where the payload isn't read). To write: record_id,
record_type, target_uri, refers_to, payload, in this order.

Defined results: a null payload is empty; null ids are kept as null; a null target is left out; control characters of
headers are percent-encoded; an empty table makes an archive without records; of equal payloads, all rows of
the smallest page_id are responses; extra columns of pages are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage,
)

READ = "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, payload_length long, payload binary, digest_ok boolean"
PUSHED = ("record_id", "record_type", "target_uri", "refers_to")
SPLIT = 32 << 20
CHUNK = 64 << 10
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(re.sub("^file:/*", "file:///", path))
    return fs.LocalFileSystem(), path


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value: str) -> str:
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(record_id, kind, uri, refers_to, payload: bytes) -> bytes:
    """One WARC record, not compressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", "WARC-Date: 1970-01-01T00:00:00Z"]
    for name, value in (("WARC-Record-ID", record_id), ("WARC-Refers-To", refers_to)):
        if value is not None:
            head.append(f"{name}: <{_clean(value)}>")
    if uri is not None:
        head.append(f"WARC-Target-URI: {_clean(uri)}")
    if kind == "revisit":
        head.append(f"WARC-Profile: {PROFILE}")
    head += [f"WARC-Payload-Digest: sha1:{digest_of(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 1) -> bytes:
    """A gzip member with the length of its compressed data in the field ``sl``."""
    press = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = press.compress(data) + press.flush()
    extra = b"sl" + struct.pack("<HQ", 8, len(body))
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + struct.pack("<LL", zlib.crc32(data), len(data) & 0xFFFFFFFF)


MANIFEST = "_manifest"


class Written(WriterCommitMessage):
    def __init__(self, name: str | None):
        self.name = name


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool = False):
        self.path, self.overwrite = path, overwrite

    def write(self, iterator) -> Written:
        files, root = _opened(self.path)
        files.create_dir(root, recursive=True)
        name, at, offsets = f"part-{uuid.uuid4().hex}.warc.gz", 0, []
        with files.open_output_stream(f"{root}/{name}", compression=None) as out:
            for batch in iterator:
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    data = member(record(*row[:4], row[4] or b""))
                    offsets.append(at)
                    at += out.write(data)
        if not offsets:
            return Written(None)
        with files.open_output_stream(f"{root}/{name}.idx", compression=None) as out:
            out.write(struct.pack(f"<{len(offsets) + 1}Q", *offsets, at))
        return Written(name)

    def commit(self, messages) -> None:
        files, root = _opened(self.path)
        files.create_dir(root, recursive=True)
        before = _manifests(files, root) if self.overwrite else []
        with files.open_output_stream(f"{root}/{MANIFEST}-{uuid.uuid4().hex}", compression=None) as out:
            out.write(json.dumps(sorted(m.name for m in messages if m and m.name)).encode())
        for name in before:
            files.delete_file(f"{root}/{name}")

    def abort(self, messages) -> None:
        files, root = _opened(self.path)
        for m in messages:
            for name in (m.name, f"{m.name}.idx") if m and m.name else ():
                files.delete_file(f"{root}/{name}")


def _manifests(files, root: str) -> list[str]:
    return sorted(f.base_name for f in files.get_file_info(fs.FileSelector(root)) if f.base_name.startswith(MANIFEST))


class Range(InputPartition):
    def __init__(self, name: str, start: int, end: int | None):
        self.name, self.start, self.end = name, start, end


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.split = options["path"], int(options.get("split", SPLIT))
        self.payload = options.get("payload", "true").lower() != "false"
        self.wanted: list[tuple[str, str, tuple]] = []

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if len(f.attribute) == 1 else ""
            if column in PUSHED and isinstance(f, EqualTo):
                self.wanted.append((column, "in", (f.value,)))
            elif column in PUSHED and isinstance(f, In):
                self.wanted.append((column, "in", tuple(f.value)))
            elif column in PUSHED and isinstance(f, StringStartsWith):
                self.wanted.append((column, "starts", (f.value,)))
            elif column in PUSHED and isinstance(f, IsNotNull):
                self.wanted.append((column, "there", ()))
            else:
                yield f

    def partitions(self):
        files, root = _opened(self.path)
        names = {f.base_name for f in files.get_file_info(fs.FileSelector(root))}
        manifests = _manifests(files, root)
        chosen = []
        for name in manifests:
            with files.open_input_stream(f"{root}/{name}", compression=None) as got:
                chosen += json.loads(got.read())
        if not manifests:
            chosen = sorted(n for n in names if n.endswith((".warc", ".warc.gz")))
        out = []
        for name in chosen:
            if f"{name}.idx" not in names:
                out.append(Range(name, 0, None))
                continue
            with files.open_input_stream(f"{root}/{name}.idx", compression=None) as got:
                raw = got.read()
            offsets = struct.unpack(f"<{len(raw) // 8}Q", raw)
            start = offsets[0]
            for a in offsets[1:]:
                if a - start >= self.split or a == offsets[-1]:
                    out.append(Range(name, start, a))
                    start = a
        return out or [Range("", 0, 0)]

    def _refused(self, row: dict) -> bool:
        for column, how, values in self.wanted:
            value = row[column]
            if value is None or how == "in" and value not in values or how == "starts" and not value.startswith(values[0]):
                return True
        return False

    def read(self, partition: Range):
        schema = pa.schema([(c.split()[0], {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}[c.split()[1]]) for c in READ.split(", ")])
        if not partition.name:
            return
        files, root = _opened(self.path)
        rows, size = [], 0
        with files.open_input_file(f"{root}/{partition.name}") as file:
            end = partition.end if partition.end is not None else file.size()
            source = _members if partition.name.endswith(".gz") else _plain
            for head, rest, skip in source(file, partition.start, end):
                row = parsed(head)
                if row is None or self._refused(row):
                    skip()
                    continue
                if self.payload and row["record_type"] == "response":
                    row["payload"] = block_payload(rest(row.pop("_block")))
                    row["payload_length"] = len(row["payload"])
                    row["digest_ok"] = digest_of(row["payload"]) == row["payload_digest"]
                    size += row["payload_length"]
                elif row["record_type"] in ("response", "revisit"):
                    row["payload_length"] = http_length(rest(row.pop("_block"), 4096))
                skip()
                rows.append(row)
                if len(rows) >= 2000 or size >= 8 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


def parsed(head: bytes) -> dict | None:
    """The fields of a record's headers; None if it is no WARC record."""
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        return None
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    bare = lambda name: fields[name].strip("<>") if name in fields else None
    digest = fields.get("warc-payload-digest")
    return {
        "record_id": bare("warc-record-id"), "record_type": fields.get("warc-type"), "target_uri": fields.get("warc-target-uri"), "refers_to": bare("warc-refers-to"),
        "payload_digest": digest.partition(":")[2] if digest else None, "_block": int(fields.get("content-length", 0)),
    }


def block_payload(block: bytes) -> bytes:
    return block.partition(b"\r\n\r\n")[2]


def http_length(start: bytes) -> int | None:
    got = re.search(rb"(?i)\r\ncontent-length: *(\d+)", start.partition(b"\r\n\r\n")[0])
    return int(got[1]) if got else None


def _members(file, start: int, end: int):
    """Each record of a gzip file as its headers, a way to read (so much of) its block, and a way past it."""
    at = start
    while at < end:
        file.seek(at)
        fixed = file.read(12)
        if fixed[:2] != b"\x1f\x8b" or fixed[3] & ~4:
            raise ValueError(f"no plain gzip member at byte {at}")
        extra = file.read(struct.unpack("<H", fixed[10:12])[0]) if fixed[3] & 4 else b""
        if not fixed[3] & 4:
            file.seek(at + 10)
        length = struct.unpack("<Q", extra[4:12])[0] if extra[:2] == b"sl" else None
        body = at + 10 + (2 + len(extra) if fixed[3] & 4 else 0)
        state = {"z": zlib.decompressobj(-15), "data": b"", "at": body}

        def more(state=state, length=length, body=body) -> bool:
            if state["z"].eof:
                return False
            file.seek(state["at"])
            raw = file.read(CHUNK if length is None else min(CHUNK, body + length - state["at"]))
            if not raw:
                raise ValueError("a gzip member ends early")
            state["at"] += len(raw)
            state["data"] += state["z"].decompress(raw)
            return True

        while b"\r\n\r\n" not in state["data"] and more():
            pass
        head, _, _ = state["data"].partition(b"\r\n\r\n")
        begin = len(head) + 4

        def rest(n: int, most: int | None = None, state=state, begin=begin, more=more) -> bytes:
            n = n if most is None else min(n, most)
            parts = [state["data"]]
            have = len(parts[0])
            while have < begin + n:
                state["data"] = b""
                if not more():
                    break
                parts.append(state["data"])
                have += len(state["data"])
            state["data"] = b"".join(parts)
            return state["data"][begin : begin + n]

        past: list[int] = []

        def skip(state=state, length=length, body=body, more=more, past=past) -> None:
            if length is None:
                while more():
                    state["data"] = b""
                past.append(state["at"] - len(state["z"].unused_data) + 8)
            else:
                past.append(body + length + 8)

        yield head, rest, skip
        at = past[0]


def _plain(file, start: int, end: int):
    at = start
    while at < end:
        file.seek(at)
        data = b""
        while b"\r\n\r\n" not in data and (raw := file.read(CHUNK)):
            data += raw
        head, _, _ = data.partition(b"\r\n\r\n")
        length = int(m[1]) if (m := re.search(rb"(?i)\r\ncontent-length: *(\d+)", head)) else 0
        begin = at + len(head) + 4

        def rest(n: int, most: int | None = None, begin=begin) -> bytes:
            file.seek(begin)
            return file.read(n if most is None else min(n, most))

        yield head, rest, lambda: None
        at = begin + length + 4


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], overwrite)


def write_pages(pages: DataFrame, path: str, least: int = 0) -> None:
    """A record for each page. Of equal payloads of at least ``least`` bytes, that of the smallest page_id is a
    response and the others revisit it."""
    pages.sparkSession.dataSource.register(WarcSource)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    digest = F.when(F.octet_length("payload") >= least, F.sha1("payload")).alias("digest")
    rows = rows.select("*", digest)
    first = rows.where("digest is not null").groupBy("digest").agg(F.min("page_id").alias("first"))
    again = (F.col("first") != F.col("page_id")) | (F.col("page_id").isNull() & F.col("first").isNotNull())
    urn = lambda c: F.concat(F.lit("urn:page:"), F.col(c).cast("string"))
    rows.join(first, "digest", "left").select(
        urn("page_id").alias("record_id"), F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"), F.when(again, urn("first")).alias("refers_to"), "payload",
    ).write.format("warc").mode("append").save(path)


def read(spark, path: str, **options) -> DataFrame:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").options(**options).load(path)


def query(spark, sf_dir: str) -> DataFrame:
    """op8: every page written to archives and read back; the digest and length of a response are those of its payload."""
    from pagelex.llm.common import scratch, table

    path = scratch(spark, "warc")
    write_pages(table(spark, sf_dir, "pages"), path)
    page = lambda c: F.substring_index(c, ":", -1).cast("long")
    return read(spark, path).select(
        page("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"),
        F.when(F.coalesce("digest_ok", F.lit(True)), F.col("payload_digest")).alias("payload_digest"), "record_type", page("refers_to").alias("refers_to"),
    )


ORACLE = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages),
f AS (SELECT page_id, n, d, min(page_id) OVER (PARTITION BY d) AS first FROM p),
bits AS (SELECT *, [((strpos('0123456789abcdef', d[i // 4 + 1]) - 1) >> CAST(3 - i % 4 AS INTEGER)) & 1 FOR i IN range(0, 160)] AS b FROM f)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(['ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + b[5*k+1]*16 + b[5*k+2]*8 + b[5*k+3]*4 + b[5*k+4]*2 + b[5*k+5]] FOR k IN range(0, 32)], '') AS payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to
FROM bits
"""
