"""LAS point files: a header reader, a writer for point format 0 and a partitioned Spark data source.

A partition is a run of points of a file, read with one seek; column x, y, z are scaled, empty files have no rows.
Compressed LAZ files need a decompressor that is not here and are refused by name.
"""

from __future__ import annotations

import glob
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

POINTS_A_PARTITION = 2_000_000
SCHEMA = "file_id string, x double, y double, z double, classification smallint"


@dataclass(frozen=True)
class Header:
    offset: int
    format: int
    length: int
    count: int
    scale: tuple[float, float, float]
    shift: tuple[float, float, float]
    bounds: tuple[float, float, float, float]
    packed: bool
    epsg: int | None


def _key_code(raw: bytes) -> int | None:
    """The code of a directory of GeoTIFF keys: that of a projected system, else of a geographic one."""
    found = {}
    for k in range(min(struct.unpack_from("<H", raw, 6)[0], (len(raw) - 8) // 8) if len(raw) >= 8 else 0):
        key, place, _, value = struct.unpack_from("<4H", raw, 8 + 8 * k)
        if place == 0:
            found[key] = value
    code = found.get(3072) or found.get(2048)
    return code if code and code != 32767 else None


def _text_code(raw: bytes) -> int | None:
    """The code of the horizontal part of a system's text: the last one before a vertical part begins."""
    text = raw.split(b"\0")[0].decode("utf-8", "replace")
    for vertical in ("VERT_CS", "VERTCRS", "VERTICALCRS"):
        text = text.split(vertical)[0]
    codes = re.findall(r"""(?:AUTHORITY|ID)\["EPSG",\s*"?(\d+)"?\]""", text)
    return int(codes[-1]) if codes else None


def parse_header(raw: bytes, name: str = "the file") -> Header:
    """From the first bytes of a point cloud, packed or not; the code is null where the records that hold it are not among them."""
    if raw[:4] != b"LASF" or len(raw) < 227:
        raise ValueError(f"{name} is no LAS file")
    minor, size = raw[25], struct.unpack_from("<H", raw, 94)[0]
    offset, records, kind, length, count = struct.unpack_from("<IIBHI", raw, 96)
    if minor >= 4 and size >= 375 and len(raw) >= 255:
        count = struct.unpack_from("<Q", raw, 247)[0]
    scale, shift = struct.unpack_from("<3d", raw, 131), struct.unpack_from("<3d", raw, 155)
    maxx, minx, maxy, miny = struct.unpack_from("<4d", raw, 179)
    at, epsg = size, None
    for _ in range(records):
        if at + 54 > len(raw):
            break
        user, record, long = raw[at + 2 : at + 18].rstrip(b"\0"), *struct.unpack_from("<HH", raw, at + 18)
        body = raw[at + 54 : at + 54 + long]
        if user == b"LASF_Projection" and len(body) == long:
            epsg = _text_code(body) or epsg if record == 2112 else epsg or _key_code(body) if record == 34735 else epsg
        at += 54 + long
    return Header(offset, kind & 63, length, count, scale, shift, (minx, miny, maxx, maxy), bool(kind & 128) or name.lower().endswith(".laz"), epsg)


def read_header(path: str) -> Header:
    with open(path, "rb") as f:
        raw = f.read(375)
        raw += f.read(max(0, struct.unpack_from("<I", raw, 96)[0] - 375)) if len(raw) >= 100 else b""
    return parse_header(raw, path)


def system_of(header: Header, fallback: str | None = None) -> str:
    """The system that a header names, else the one that a rule gives; none is an error."""
    if header.epsg:
        return f"EPSG:{header.epsg}"
    if fallback:
        return fallback
    raise ValueError("neither the header nor a rule names a coordinate system")


def write_las(path: str, x: np.ndarray, y: np.ndarray, z: np.ndarray, classification: np.ndarray, scale: float = 0.001) -> None:
    """Version 1.2, point format 0."""
    n = len(x)
    spans = [v for a in (x, y, z) for v in ((float(a.max()), float(a.min())) if n else (0.0, 0.0))]
    head = b"LASF" + struct.pack("<HHIHH8sBB32s32sHHHIIBHI5I", 0, 0, 0, 0, 0, b"", 1, 2, b"", b"geoloom", 1, 2024, 227, 227, 0, 0, 20, n, n, 0, 0, 0, 0)
    head += struct.pack("<12d", scale, scale, scale, 0.0, 0.0, 0.0, *spans)
    rows = np.zeros(n, np.dtype([("p", "<i4", 3), ("i", "<u2"), ("f", "u1"), ("c", "u1"), ("r", "V4")]))
    for k, a in enumerate((x, y, z)):
        rows["p"][:, k] = np.rint(np.asarray(a) / scale)
    rows["c"] = classification
    with open(path, "wb") as f:
        f.write(head + rows.tobytes())


def read_points(path: str, head: Header, first: int, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """x, y, z and class of a run of points, read with one seek."""
    class_at = 16 if head.format >= 6 else 15
    kind = np.dtype({"names": ["p", "c"], "formats": [("<i4", 3), "u1"], "offsets": [0, class_at], "itemsize": head.length})
    with open(path, "rb") as f:
        f.seek(head.offset + first * head.length)
        rows = np.frombuffer(f.read(count * head.length), kind)
    x, y, z = (rows["p"][:, k] * head.scale[k] + head.shift[k] for k in range(3))
    return x, y, z, rows["c"] & (31 if head.format < 6 else 255)


@dataclass
class Run(InputPartition):
    path: str
    first: int
    count: int


class LasReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = sorted(glob.glob(options["path"]))
        self.size = int(options.get("pointsPerPartition", POINTS_A_PARTITION))

    def partitions(self) -> list[Run]:
        heads = [(p, read_header(p)) for p in self.paths]
        if packed := [p for p, head in heads if head.packed]:
            raise ValueError(f"{packed[0]} is compressed; only LAS is read")
        return [Run(p, at, min(self.size, head.count - at)) for p, head in heads for at in range(0, head.count, self.size)] or [Run("", 0, 0)]

    def read(self, run: Run) -> Iterator[pa.RecordBatch]:
        if not run.count:
            return
        x, y, z, classes = read_points(run.path, read_header(run.path), run.first, run.count)
        name = pa.array([run.path.rpartition("/")[2]] * len(x), pa.string())
        yield pa.RecordBatch.from_arrays([name, pa.array(x), pa.array(y), pa.array(z), pa.array(classes.astype(np.int16))], names=["file_id", "x", "y", "z", "classification"])


class LasSource(DataSource):
    """spark.dataSource.register(LasSource); spark.read.format("las").load("/points/*.las")"""

    @classmethod
    def name(cls) -> str:
        return "las"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LasReader:
        return LasReader(self.options)
