"""Shapefiles of points and polygons as a Spark data source: a partition is a run of records, found by the index file.

Rows: feature_index, geometry_type, polygons (an outer ring and its holes each), bounds, properties by field name
(trimmed text; blank is null) and the text of the .prj file. Deleted table rows and null shapes are left out.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from geoloom.functions.polygons import signed_area

RECORDS_A_PARTITION = 50_000
SCHEMA = "feature_index int, geometry_type string, polygons array<array<array<struct<x:double,y:double>>>>, minx double, miny double, maxx double, maxy double, properties map<string,string>, crs string"
# Shape codes with their variants for heights and measures.
POINTS, POLYGONS = (1, 11, 21), (5, 15, 25)


def _beside(path: str, extension: str) -> str:
    stem = os.path.splitext(path)[0]
    return next((stem + e for e in (extension, extension.upper()) if os.path.exists(stem + e)), stem + extension)


def _holds(ring: list, point: tuple[float, float]) -> bool:
    inside = False
    for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]], strict=True):
        if (ay > point[1]) != (by > point[1]) and point[0] < (bx - ax) * (point[1] - ay) / (by - ay) + ax:
            inside = not inside
    return inside


def polygons_of(rings: list[list[tuple[float, float]]]) -> list[list[list[tuple[float, float]]]]:
    """Outer rings turn right, holes left; a hole goes to the smallest outer ring around it, or stands alone."""
    outer = [[r] for r in rings if signed_area(r) <= 0]
    for hole in (r for r in rings if signed_area(r) > 0):
        around = [p for p in outer if _holds(p[0], hole[0])]
        if around:
            min(around, key=lambda p: abs(signed_area(p[0]))).append(hole)
        else:
            outer.append([hole])
    return outer


@dataclass(frozen=True)
class Table:
    """Where the attribute table keeps rows and fields."""

    start: int
    length: int
    fields: tuple[tuple[str, int, int], ...]
    encoding: str


def read_table(path: str) -> Table:
    with open(_beside(path, ".dbf"), "rb") as f:
        head = f.read(32)
        start, length = struct.unpack_from("<HH", head, 8)
        raw = f.read(start - 32)
    fields, at = [], 1
    for k in range(0, len(raw) - 31, 32):
        if raw[k] == 13:
            break
        fields.append((raw[k : k + 11].split(b"\0")[0].decode("ascii", "replace"), at, raw[k + 16]))
        at += raw[k + 16]
    named = _beside(path, ".cpg")
    encoding = open(named).read().strip() if os.path.exists(named) else "latin-1"
    return Table(start, length, tuple(fields), {"65001": "utf-8"}.get(encoding, encoding))


@dataclass
class Run(InputPartition):
    first: int
    count: int


class ShapefileReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.size = options["path"], int(options.get("recordsPerPartition", RECORDS_A_PARTITION))

    def partitions(self) -> list[Run]:
        n = (os.path.getsize(_beside(self.path, ".shx")) - 100) // 8
        return [Run(k, min(self.size, n - k)) for k in range(0, n, self.size)] or [Run(0, 0)]

    def read(self, run: Run) -> Iterator[tuple]:
        if not run.count:
            return
        table, projection = read_table(self.path), _beside(self.path, ".prj")
        crs = open(projection).read().strip() if os.path.exists(projection) else None
        with open(_beside(self.path, ".shx"), "rb") as f:
            f.seek(100 + 8 * run.first)
            index = struct.unpack(f">{2 * run.count}i", f.read(8 * run.count))
        with open(_beside(self.path, ".shp"), "rb") as shapes, open(_beside(self.path, ".dbf"), "rb") as rows:
            rows.seek(table.start + run.first * table.length)
            for k in range(run.count):
                row = rows.read(table.length)
                shapes.seek(2 * index[2 * k] + 8)
                raw = shapes.read(2 * index[2 * k + 1])
                code = struct.unpack_from("<i", raw)[0]
                if row[:1] == b"*" or code == 0:
                    continue
                if code in POINTS:
                    kind, parts = "Point", [[[struct.unpack_from("<2d", raw, 4)]]]
                elif code in POLYGONS:
                    n_rings, n_points = struct.unpack_from("<2i", raw, 36)
                    starts = [*struct.unpack_from(f"<{n_rings}i", raw, 44), n_points]
                    flat = struct.unpack_from(f"<{2 * n_points}d", raw, 44 + 4 * n_rings)
                    points = list(zip(flat[::2], flat[1::2], strict=True))
                    parts = polygons_of([points[a:b] for a, b in zip(starts, starts[1:], strict=False)])
                    kind = "Polygon" if len(parts) == 1 else "MultiPolygon"
                else:
                    raise ValueError(f"shape code {code} is no point and no polygon")
                xs, ys = zip(*(p for part in parts for ring in part for p in ring), strict=True)
                properties = {name: row[at : at + size].decode(table.encoding).strip(" \0") or None for name, at, size in table.fields}
                yield run.first + k, kind, parts, min(xs), min(ys), max(xs), max(ys), properties, crs


class ShapefileSource(DataSource):
    """spark.dataSource.register(ShapefileSource); spark.read.format("shapefile").load("/regions.shp")"""

    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ShapefileReader:
        return ShapefileReader(self.options)
