"""WARC archives as seekable Zstandard bundles.

A task groups its records into independent Zstandard frames and its frames into bundles. A bundle ends in a seek
table, a skippable frame with the packed and plain size of each frame, as the public seekable format has it. The
index maps a record to its bundle, frame and offset inside the plain frame, so that one record is read with one
seek and one frame. Equal payloads are stored once: the smallest page is the response, the others are revisits.

Bundles are written to the shared folder under a name of the task attempt and renamed when they are whole; the
index, kept in a checkpoint, names only those of attempts that succeeded, so a lost executor leaves unused files
at most. Files go through pyarrow's file systems, which the folder's scheme selects.

Defined cases: a null page is an empty payload, a null url an empty target; payloads of fewer than least_bytes
are responses always. Of equal payloads under one page_id, one row is the response and the others refer to it; a
null page_id sorts after all others. An empty table makes no bundle and gives no rows. Only page_id, url and html
are read, so other columns cannot clash. A record larger than a frame has a frame of its own. The pages must be a table, or a
plan that gives the same rows in the same order again.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm.common import checkpoint, fresh_dir, pieces, small_batches

FRAME_BYTES, BUNDLE_BYTES = 1 << 20, 256 << 20
#: Neighbouring frames of a bundle that are read together.
FRAMES_A_TASK = 16
LEVEL = 3
#: Of the seekable format: the magic of a skippable frame, that of the table's foot, and the foot's size.
SKIPPABLE, SEEKABLE, FOOT = 0x184D2A5E, 0x8F92EAB1, 9
WRITTEN = "1970-01-01T00:00:00Z"
INDEX = "page_id long, bundle string, frame int, at long, size long, record_type string"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """A WARC 1.1 record. Its block holds the HTTP head and, for a response, the payload; the head's length is that of the payload either way."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if revisit else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {WRITTEN}",
        f"WARC-Target-URI: {' '.join(url.split())}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(block)}",
    ]
    if revisit:
        lines[-1:-1] = ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class Record:
    page_id: int | None
    record_type: str
    payload: bytes | None  # None for a revisit
    payload_bytes: int
    payload_digest: str
    refers_to: int | None


def parse(raw: bytes, at: int = 0) -> tuple[Record, int]:
    """The record at a place of a plain frame, and the place after it."""
    end = raw.index(b"\r\n\r\n", at)
    lines = raw[at:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no record at {at}")
    head = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    start, size = end + 4, int(head["Content-Length"])
    block = raw[start : start + size]
    body = block.index(b"\r\n\r\n") + 4
    length = int(block[:body].split(b"Content-Length: ")[1].split(b"\r\n")[0])
    name = lambda key: (lambda v: int(v) if v else None)(head.get(key, "")[len("<urn:page:") : -1])
    revisit = head["WARC-Type"] == "revisit"
    found = head["WARC-Payload-Digest"].removeprefix("sha1:")
    payload = None if revisit else block[body:]
    if payload is not None and (len(payload) != length or digest(payload) != found):
        raise ValueError(f"the payload at {at} is damaged")
    return Record(name("WARC-Record-ID"), head["WARC-Type"], payload, length, found, name("WARC-Refers-To") if revisit else None), start + size + 4


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    body = b"".join(struct.pack("<II", *s) for s in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


class Bundle:
    """Reads frames of a bundle by its seek table."""

    def __init__(self, uri: str):
        system, path = pafs.FileSystem.from_uri(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        count, flags, magic = struct.unpack("<IBI", self.file.read_at(FOOT, size - FOOT))
        if magic != SEEKABLE:
            raise ValueError(f"{uri} has no seek table")
        entry = 12 if flags & 128 else 8
        raw = self.file.read_at(count * entry, size - FOOT - count * entry)
        self.frames, at = [], 0
        for k in range(count):
            packed, plain = struct.unpack_from("<II", raw, k * entry)
            self.frames.append((at, packed, plain))
            at += packed

    def frame(self, k: int) -> bytes:
        at, packed, plain = self.frames[k]
        return zstandard.ZstdDecompressor().decompress(self.file.read_at(packed, at), max_output_size=plain)

    def record(self, frame: int, at: int) -> Record:
        return parse(self.frame(frame), at)[0]

    def close(self) -> None:
        self.file.close()


class _Writer:
    """The bundle that a task writes just now."""

    def __init__(self, folder: str):
        self.folder, self.system = folder, pafs.FileSystem.from_uri(folder)[0]
        self.packer = zstandard.ZstdCompressor(level=LEVEL)
        self.rows: list[list] = []  # of the index, bundle by bundle
        self._open()

    def _open(self) -> None:
        self.name = f"{self.folder}/{uuid.uuid4().hex}.warc.zst"
        self.out, self.sizes, self.bytes = None, [], 0
        self.plain, self.held = [], 0

    def add(self, page_id: int | None, kind: str, raw: bytes) -> None:
        if self.held and self.held + len(raw) > FRAME_BYTES:
            self.end_frame()
        self.rows.append([page_id, self.name, len(self.sizes), self.held, len(raw), kind])
        self.plain.append(raw)
        self.held += len(raw)

    def end_frame(self) -> None:
        if self.out is None:
            self.path = pafs.FileSystem.from_uri(self.name)[1]
            self.out = self.system.open_output_stream(self.path + ".part")
        packed = self.packer.compress(b"".join(self.plain))
        self.out.write(packed)
        self.sizes.append((len(packed), self.held))
        self.bytes += len(packed)
        self.plain, self.held = [], 0

    def end_bundle(self) -> list[list]:
        if self.held:
            self.end_frame()
        rows, self.rows = self.rows, []
        if self.out is not None:
            self.out.write(seek_table(self.sizes))
            self.out.close()
            self.system.move(self.path + ".part", self.path)
        self._open()
        return rows


def _index(rows: list[list]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string())
    names = ("page_id", "bundle", "frame", "at", "size", "record_type")
    return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], kind) for j, kind in enumerate(kinds)], names=names)


def roles(pages: DataFrame, least_bytes: int) -> DataFrame:
    """(page_id, url, payload, refers_to, revisit): each page with the page it revisits, if any."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"), F.monotonically_increasing_id().alias("row"))
    rows = rows.withColumn("same", F.when(F.length("payload") >= least_bytes, F.unhex(F.sha2("payload", 256))))
    order = F.struct(F.col("page_id").isNull().alias("unnamed"), F.col("page_id"), F.col("row"))
    first = rows.where("same is not null").groupBy("same").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    joined = rows.join(first, "same", "left")
    revisit = F.col("first").isNotNull() & (F.col("first.row") != F.col("row"))
    return joined.select("page_id", "url", "payload", F.when(revisit, F.col("first.page_id")).alias("refers_to"), F.coalesce(revisit, F.lit(False)).alias("revisit"))


def write(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Writes the bundles and returns the index: page_id, bundle, frame, at, size, record_type."""
    spark = pages.sparkSession
    small_batches(spark)
    pafs.FileSystem.from_uri(folder)[0].create_dir(pafs.FileSystem.from_uri(folder)[1], recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = _Writer(folder)
        for batch in pieces(batches, 8 << 20):
            for page_id, url, payload, refers_to, revisit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                writer.add(page_id, "revisit" if revisit else "response", record(page_id, url, payload, refers_to, revisit))
            if writer.bytes >= BUNDLE_BYTES:
                yield _index(writer.end_bundle())
        yield _index(writer.end_bundle())

    return checkpoint(roles(pages, least_bytes).mapInArrow(run, INDEX))


def read(index: DataFrame) -> DataFrame:
    """Every record of the bundles of an index, read back frame by frame: page_id, payload_bytes, payload_digest, record_type, refers_to, payload (null for revisits)."""
    small_batches(index.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, name = None, None
        for batch in batches:
            for uri, frames in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if uri != name:
                    if bundle:
                        bundle.close()
                    bundle, name = Bundle(uri), uri
                for frame in sorted(frames):
                    raw, at, rows = bundle.frame(frame), 0, []
                    while at < len(raw):
                        found, at = parse(raw, at)
                        rows.append(found)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r.page_id for r in rows], pa.int64()), pa.array([r.payload_bytes for r in rows], pa.int64()), pa.array([r.payload_digest for r in rows], pa.string()), pa.array([r.record_type for r in rows], pa.string()), pa.array([r.refers_to for r in rows], pa.int64()), pa.array([r.payload for r in rows], pa.binary())],
                        names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"],
                    )
        if bundle:
            bundle.close()

    ranges = index.groupBy("bundle", F.floor(F.col("frame") / FRAMES_A_TASK).alias("range")).agg(F.collect_set("frame").alias("frames")).select("bundle", "frames").sortWithinPartitions("bundle")
    return ranges.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def archive(spark: SparkSession, pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes pages to new bundles in the shared folder and reads them back."""
    return read(write(pages, fresh_dir(spark, "warc"), least_bytes))
