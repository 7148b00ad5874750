"""WARC archives as seekable Zstandard bundles.

A bundle is a series of independent Zstandard frames, each with whole WARC/1.1 records, and ends with the seek table of
the public seekable format: a skippable frame (magic 0x184D2A5E) with an entry for each frame (compressed and plain size)
and a footer (number of frames, descriptor byte, magic 0x8F92EAB1). An index maps each record identifier to bundle, frame,
offset within the frame's plain bytes, and length, so that one record costs one ranged read and one small frame.

Of records with equal payloads (of `min_revisit` bytes at least) the one with the smallest identifier is the response;
the others are revisits that name it and carry no payload. Digests are partial aggregates; only those that occur twice go
into the join with the pages, and the join is salted, so a payload that a third of all pages share spreads over tasks.

Files are written under a name of their own for each task attempt, and only those in the committed index are ever read:
a lost executor leaves an unread file at most. Bundles go to the folder that all executors share, by its URI.

Defined results: null payloads are empty; empty and small payloads are always responses; a null identifier is written as
an empty one, counts as larger than any other, and comes back null; rows that repeat with the smallest identifier of
their payload are all responses; extra columns are ignored; an empty table makes no bundle.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, new_path, small_batches

#: Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEK_MAGIC = 0x8F92EAB1

INDEX_SCHEMA = "page_id string, bundle string, frame int, offset long, length long, frame_start long, frame_size long"


def _safe(value: str) -> str:
    """A header's value: control characters, which would end it, and `%` itself as %XX."""
    return re.sub(r"[%\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(page_id: str | None, url: str, payload: bytes, digest: str, refers_to: str | None, n_bytes: int) -> bytes:
    """One WARC/1.1 record: a response, or a revisit of refers_to. A null id has no header."""
    body = payload if refers_to is None else b""
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}:{digest}')}>",
        f"WARC-Target-URI: {' '.join(url.split())}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}", *([] if page_id is None else [f"X-Page-Id: {_safe(page_id)}"]), f"X-Payload-Length: {n_bytes}",
    ]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page: {_safe(refers_to)}"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers, body, where the next record starts) of the record at `at`."""
    end = data.index(b"\r\n\r\n", at)
    first, *lines = data[at:end].decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("no WARC record here")
    head = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    size = int(head["Content-Length"])
    body = data[end + 4 : end + 4 + size]
    if data[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
        raise ValueError("record without its end")
    return head, body, end + 8 + size


class BundleWriter:
    """Groups records into frames of about frame_bytes and writes them with a seek table at the end."""

    def __init__(self, out, frame_bytes: int, level: int = 3):
        self.out, self.frame_bytes, self.packer = out, frame_bytes, zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.frames: list[tuple[int, int]] = []
        self.parts: list[bytes] = []
        self.size = self.at = 0
        self.pending: list[tuple[str | None, int, int]] = []

    def add(self, page_id: str | None, data: bytes) -> list[tuple[str, int, int, int, int, int]]:
        """Index rows (id, frame, offset, length, frame start, frame size) of the frames that this record filled."""
        self.pending.append((page_id, self.size, len(data)))
        self.parts.append(data)
        self.size += len(data)
        return self.flush() if self.size >= self.frame_bytes else []

    def flush(self) -> list[tuple[str, int, int, int, int, int]]:
        if not self.parts:
            return []
        packed = self.packer.compress(b"".join(self.parts))
        self.out.write(packed)
        rows = [(i, len(self.frames), offset, length, self.at, len(packed)) for i, offset, length in self.pending]
        self.frames.append((len(packed), self.size))
        self.at += len(packed)
        self.parts, self.pending, self.size = [], [], 0
        return rows

    def close(self) -> None:
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)


def seek_table(source) -> list[tuple[int, int, int]]:
    """(start, compressed size, plain size) of each frame of an open bundle."""
    size = source.size()
    count, _, magic = struct.unpack("<IBI", source.read_at(9, size - 9))
    if magic != SEEK_MAGIC:
        raise ValueError("no seek table")
    raw, out, at = source.read_at(8 * count, size - 9 - 8 * count), [], 0
    for packed, plain in struct.iter_unpack("<II", raw):
        out.append((at, packed, plain))
        at += packed
    return out


def _file(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def read_record(uri: str, frame: int, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """One record by its place: the footer's seek table finds the frame, one ranged read gets it."""
    store, path = _file(uri)
    with store.open_input_file(path) as source:
        start, size, _ = seek_table(source)[frame]
        plain = zstandard.ZstdDecompressor().decompress(source.read_at(size, start))
    head, body, _ = parse(plain[offset : offset + length])
    return head, body


def typed(pages: DataFrame, min_revisit: int, salts: int) -> DataFrame:
    """(page_id string, url, payload, payload_bytes, digest, refers_to): refers_to is null for responses."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), payload.alias("payload"), F.octet_length(payload).cast("bigint").alias("payload_bytes"), F.sha2(payload, 256).alias("digest"))
    twice = rows.filter(F.col("payload_bytes") >= min_revisit).groupBy(F.col("digest").alias("d")).agg(F.count("*").alias("n"), F.min("page_id").alias("first")).filter("n > 1 AND first IS NOT NULL").drop("n")
    twice = twice.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salt = F.pmod(F.xxhash64(F.coalesce(F.col("page_id").cast("string"), F.lit("")), "url"), F.lit(salts)).cast("int")
    rows = rows.withColumn("s", salt).join(twice, (F.col("digest") == F.col("d")) & (F.col("s") == F.col("salt")), "left")
    refers = F.when(F.col("page_id").eqNullSafe(F.col("first")), F.lit(None)).otherwise(F.col("first").cast("string"))
    return rows.select(F.col("page_id").cast("string").alias("page_id"), "url", "payload", "payload_bytes", "digest", refers.alias("refers_to"))


def write_archives(pages: DataFrame, where: str, min_revisit: int = 100, bundle_bytes: int = 256 << 20, frame_bytes: int = 256 << 10, salts: int = 16) -> DataFrame:
    """Write pages (page_id, url, html) as bundles under the URI `where`; the committed index of all records."""
    small_batches(pages.sparkSession, 200)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = _file(where)
        store.create_dir(top, recursive=True)
        task = TaskContext.get()
        name, out, writer, written, number = "", None, None, 0, 0
        rows: list[tuple] = []

        def done() -> None:
            rows.extend((r[0], name, *r[1:]) for r in writer.flush())
            writer.close()
            out.close()

        def batch_of() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["page_id", "bundle", "frame", "offset", "length", "frame_start", "frame_size"])
            rows.clear()
            return made

        for batch in batches:
            for row in batch.to_pylist():
                if writer is None:
                    name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{number:04d}.warc.zst"
                    out = store.open_output_stream(f"{top}/{name}", compression=None)
                    writer, written, number = BundleWriter(out, frame_bytes), 0, number + 1
                data = record(row["page_id"], row["url"], row["payload"], row["digest"], row["refers_to"], row["payload_bytes"])
                rows.extend((r[0], name, *r[1:]) for r in writer.add(row["page_id"], data))
                written += len(data)
                if written >= bundle_bytes:
                    done()
                    writer = None
            if rows:
                yield batch_of()
        if writer is not None:
            done()
        if rows:
            yield batch_of()

    return cut(typed(pages, min_revisit, salts).mapInArrow(run, INDEX_SCHEMA), "warc-index")


def read_archives(index: DataFrame, where: str, id_type: str = "bigint") -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record of the bundles that index names.

    Bundles are read as any reader would: the footer's seek table finds a frame, a ranged read gets it, and each record stands at
    its offset in it. Groups of frames make a task. A record has to be that of its index row, and a response's payload is hashed
    and measured anew and must agree with its headers.
    """
    rows = index.select("bundle", "frame", "offset", "length", "page_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = _file(where)
        unpack, name, source, frames, frame, plain = zstandard.ZstdDecompressor(), None, None, [], None, b""
        for batch in batches:
            out: list[tuple] = []
            for bundle, number, offset, length, page_id in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if bundle != name:
                    if source is not None:
                        source.close()
                    name, source, frame = bundle, store.open_input_file(f"{top}/{bundle}"), None
                    frames = seek_table(source)
                if number != frame:
                    start, size, plain_size = frames[number]
                    frame, plain = number, unpack.decompress(source.read_at(size, start))
                    if len(plain) != plain_size:
                        raise ValueError(f"frame {number} of {bundle} is damaged")
                head, body, end = parse(plain, offset)
                own = None if "X-Page-Id" not in head else unquote(head["X-Page-Id"])
                digest, n = head["WARC-Payload-Digest"].removeprefix("sha256:"), int(head["X-Payload-Length"])
                if (own, end) != (page_id, offset + length) or head["WARC-Type"] == "response" and (hashlib.sha256(body).hexdigest(), len(body)) != (digest, n):
                    raise ValueError(f"record {head['WARC-Record-ID']} is damaged")
                refers = head.get("X-Refers-To-Page")
                out.append((own, n, digest, head["WARC-Type"], None if refers is None else unquote(refers)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()), strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    found = rows.repartition("bundle", "frame").sortWithinPartitions("bundle", "frame", "offset").mapInArrow(run, "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string")
    return found.select(F.col("page_id").cast(id_type), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(id_type))


def round_trip(pages: DataFrame, where: str | None = None) -> DataFrame:
    """Write pages to archives and read them back."""
    where = where or new_path(pages.sparkSession, "warc")
    id_type = pages.select("page_id").schema[0].dataType.simpleString()
    return read_archives(write_archives(pages, where), where, id_type)


#: The contract's result in SQL.
ORACLE = """
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS lowest FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND lowest IS NOT NULL AND page_id IS DISTINCT FROM lowest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM lowest THEN lowest END AS refers_to
FROM f
"""
