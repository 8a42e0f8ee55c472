"""WARC archives as a Spark data source.

Writing: each task fills archives of a bounded size, one gzip member per record, whose
extra field tells the member's compressed length. A record's identity is its page; a
response carries its payload, a revisit refers to the response of an equal payload. The
driver's commit lists the finished files, so leftovers of lost tasks are never read.

Reading: whole archives are packed into partitions of about ``split_bytes``. Of every
record the headers are inflated first and held against the pushed filters (equality,
membership and null tests on header columns). A record that fails, or whose payload the
schema does not ask for, is skipped by its length without inflating the rest; archives
without lengths are inflated past it.

Defined results: a null payload is empty; a null page id gives a record without page
header, which reads as null; equal payloads of one repeated smallest page id are all
responses; an empty table gives an archive folder without records, and reads as empty.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, In, InputPartition, IsNotNull, IsNull,
    WriterCommitMessage)

ARCHIVE_BYTES = 64 << 20
SPLIT_BYTES = 32 << 20
MANIFEST = "_archives.json"
SCHEMA = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, "
          "payload_digest string, payload binary")
_HEADS = {  # column: (header, conversion)
    "page_id": ("X-Page-Id", int), "url": ("WARC-Target-URI", str), "record_type": ("WARC-Type", str),
    "refers_to": ("X-Refers-To-Page-Id", int), "payload_bytes": ("X-Payload-Length", int),
    "payload_digest": ("WARC-Payload-Digest", lambda v: v.removeprefix("sha1:")),
}
_ARROW = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(),
          "payload_bytes": pa.int64(), "payload_digest": pa.string(), "payload": pa.binary()}


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


# --- writing --------------------------------------------------------------------------
def record(page_id, url, record_type, refers_to, payload_bytes, digest, payload) -> bytes:
    """One WARC record."""
    block = payload if record_type != "revisit" else b""
    heads = [("WARC-Type", record_type), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}')}>"),
             ("WARC-Date", "2000-01-01T00:00:00Z"), ("WARC-Target-URI", url and "".join(url.split())),
             ("X-Page-Id", page_id), ("X-Refers-To-Page-Id", refers_to), ("X-Payload-Length", payload_bytes),
             ("WARC-Payload-Digest", digest and f"sha1:{digest}"),
             ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
              if record_type == "revisit" else None),
             ("Content-Type", "text/html"), ("Content-Length", len(block))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in heads if v is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member whose extra field 'sl' holds compressed and full length."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    # magic 10, extra length 2, 'sl' 2, size 2, two lengths 8, body, checksum and length 8
    total = 24 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, total, len(data) & 0xFFFFFFFF)
    head = b"\x1f\x8b\x08\x04" + b"\0" * 5 + b"\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


class Written(WriterCommitMessage):
    def __init__(self, files: list[tuple[str, int]]):
        self.files = files


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, base = _open(self.path)
        system.create_dir(base, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    name, size = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                    size += out.write(member(record(None, None, "warcinfo", None, None, None, b"software: lakemart\r\n")))
                payload = row["payload"] or b""
                size += out.write(member(record(
                    row["page_id"], row["url"], row["record_type"], row["refers_to"], len(payload), digest_of(payload),
                    payload)))
                if size >= ARCHIVE_BYTES:
                    out.close()
                    files.append((name, size))
                    out = None
        if out is not None:
            out.close()
            files.append((name, size))
        return Written(files)

    def commit(self, messages: list) -> None:
        system, base = _open(self.path)
        system.create_dir(base, recursive=True)
        listed = sorted(f for m in messages if m is not None for f in m.files)
        with system.open_output_stream(f"{base}/{MANIFEST}", compression=None) as out:
            out.write(json.dumps(listed).encode())

    def abort(self, messages: list) -> None:
        """Without a manifest nothing is read."""


# --- reading --------------------------------------------------------------------------
class Split(InputPartition):
    def __init__(self, files: list[str]):
        self.files = files


def _heads(lines: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in lines.decode("utf-8").split("\r\n")[1:] if ": " in line)


def records(stream, wanted, with_payload: bool) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """(headers, payload or None) of the records of one archive that ``wanted(headers)`` accepts."""
    held = b""
    while True:
        if len(held) < 26:
            held += stream.read(1 << 20)
        if not held:
            return
        if held[:3] != b"\x1f\x8b\x08":
            raise ValueError("not a gzip member")
        length = struct.unpack("<I", held[16:20])[0] if held[3] & 4 and held[12:14] == b"sl" else None
        packed = zlib.decompressobj(31)
        text, fed = b"", 0
        while b"\r\n\r\n" not in text:
            piece = packed.unconsumed_tail or held[fed:fed + 4096]
            fed += 0 if packed.unconsumed_tail else len(piece)
            if not piece:
                more = stream.read(1 << 20)
                if not more:
                    raise ValueError("archive ends inside a record")
                held += more
                continue
            text += packed.decompress(piece, 4096)
        lines, _, body = text.partition(b"\r\n\r\n")
        heads = _heads(lines)
        take = wanted(heads)
        if take and with_payload or length is None:
            parts = [body]
            while not packed.eof:
                piece = packed.unconsumed_tail or held[fed:fed + (1 << 16)]
                fed += 0 if packed.unconsumed_tail else len(piece)
                if not piece:
                    more = stream.read(1 << 20)
                    if not more:
                        raise ValueError("archive ends inside a record")
                    held += more
                    continue
                parts.append(packed.decompress(piece, 1 << 20))
            body = b"".join(parts)[:int(heads["Content-Length"])]
            used = fed - len(packed.unused_data)
        else:
            used = length
        if take:
            yield heads, body if with_payload else None
        if used <= len(held):
            held = held[used:]
        else:
            stream.seek(used - len(held), 1)
            held = b""


class WarcReader(DataSourceReader):
    def __init__(self, path: str, columns: list[str], split_bytes: int):
        self.path, self.columns, self.split_bytes = path, columns, split_bytes
        self.tests: list[tuple[str, list | None, bool]] = []   # column, allowed values (None: any), null allowed

    def pushFilters(self, filters: list) -> Iterator:
        for one in filters:
            name = one.attribute[0] if len(getattr(one, "attribute", ())) == 1 else None
            if name not in _HEADS:
                yield one
            elif isinstance(one, EqualTo):
                self.tests.append((name, [one.value], False))
            elif isinstance(one, EqualNullSafe):
                self.tests.append((name, [] if one.value is None else [one.value], one.value is None))
            elif isinstance(one, In):
                self.tests.append((name, [v for v in one.value if v is not None], False))
            elif isinstance(one, IsNotNull):
                self.tests.append((name, None, False))
            elif isinstance(one, IsNull):
                self.tests.append((name, [], True))
            else:
                yield one

    def partitions(self) -> list[Split]:
        system, base = _open(self.path)
        with system.open_input_stream(f"{base}/{MANIFEST}", compression=None) as listed:
            files = json.loads(listed.read())
        splits, now, size = [], [], 0
        for name, length in files:
            if now and size + length > self.split_bytes:
                splits.append(Split(now))
                now, size = [], 0
            now, size = [*now, name], size + length
        return [*splits, Split(now)] if now or not splits else splits

    def _accepts(self, heads: dict[str, str]) -> bool:
        for name, allowed, null_ok in self.tests:
            header, convert = _HEADS[name]
            text = heads.get(header)
            if text is None:
                if not null_ok:
                    return False
            elif allowed is not None and convert(text) not in allowed:
                return False
        return True

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        system, base = _open(self.path)
        schema = pa.schema([(c, _ARROW[c]) for c in self.columns])
        with_payload = "payload" in self.columns
        rows, size = [], 0

        def batch():
            return pa.RecordBatch.from_pylist(rows, schema=schema)

        for name in partition.files:
            with system.open_input_file(f"{base}/{name}") as stream:
                for heads, payload in records(stream, self._accepts, with_payload):
                    row = {c: None if heads.get(h) is None else convert(heads[h])
                           for c, (h, convert) in _HEADS.items() if c in self.columns}
                    if with_payload:
                        row["payload"] = payload
                        stated = heads.get("WARC-Payload-Digest")
                        if heads["WARC-Type"] == "response" and stated and stated != f"sha1:{digest_of(payload)}":
                            raise ValueError(f"payload of {heads.get('X-Page-Id')} does not match its digest")
                    rows.append(row)
                    size += len(payload or b"") + 200
                    if size >= 8 << 20:
                        yield batch()
                        rows, size = [], 0
        if rows:
            yield batch()


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], schema.names, int(self.options.get("split_bytes", SPLIT_BYTES)))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def write_archives(pages: DataFrame, path: str, min_payload_bytes: int = 0) -> None:
    """One record for every row of (page_id, url, html); equal payloads below the minimum are all responses."""
    register(pages.sparkSession)
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    sized = pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload")).withColumn(
        "sha", F.sha2("payload", 256))
    firsts = sized.groupBy("sha").agg(F.min("page_id").alias("first"))
    joined = sized.join(firsts, "sha", "left")
    again = (F.col("page_id") != F.col("first")) & (F.length("payload") >= min_payload_bytes)
    again = F.coalesce(again, F.col("page_id").isNull() & F.col("first").isNotNull())
    joined.select(
        "page_id", "url", F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first")).alias("refers_to"), "payload",
    ).write.format("warc").mode("append").save(path)


def read_archives(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """Records of an archive folder; without ``payload`` no payload is inflated."""
    register(spark)
    schema = SCHEMA if payload else SCHEMA.rpartition(",")[0]
    return spark.read.format("warc").schema(schema).load(path)
