"""Well-known binary of points and polygons, plain or with heights and measures, to rings and back to bounds."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

Point = tuple[float, float]
# Geometry codes and the axes that extended codes add.
POINT, POLYGON, MULTIPOLYGON = 1, 3, 6
HEIGHT_FLAG, MEASURE_FLAG, SRID_FLAG = 0x80000000, 0x40000000, 0x20000000


def _geometry(raw: bytes, at: int) -> tuple[int, list[list[list[Point]]], int]:
    order = "<" if raw[at] else ">"
    code = struct.unpack_from(order + "I", raw, at + 1)[0]
    at += 5 + (4 if code & SRID_FLAG else 0)
    plain = code & 0x0FFFFFFF
    axes = 2 + (bool(code & HEIGHT_FLAG) + bool(code & MEASURE_FLAG) or (0, 1, 1, 2)[plain // 1000])
    kind = plain % 1000

    def line(at: int, count: int) -> tuple[list[Point], int]:
        flat = struct.unpack_from(f"{order}{count * axes}d", raw, at)
        return list(zip(flat[::axes], flat[1::axes], strict=True)), at + 8 * count * axes

    if kind == POINT:
        points, at = line(at, 1)
        return kind, [] if points[0][0] != points[0][0] else [[points]], at
    count = struct.unpack_from(order + "I", raw, at)[0]
    at += 4
    if kind == POLYGON:
        rings = []
        for _ in range(count):
            points, at = line(at + 4, struct.unpack_from(order + "I", raw, at)[0])
            rings.append(points)
        return kind, [rings] if rings else [], at
    if kind == MULTIPOLYGON:
        parts = []
        for _ in range(count):
            _, own, at = _geometry(raw, at)
            parts += own
        return kind, parts, at
    raise ValueError(f"geometry type {kind} is no point and no polygon")


def parse(raw: bytes) -> tuple[str, list[list[list[Point]]]]:
    """(type, polygons of rings of points); a point is a polygon of one ring of one point, empty shapes have none."""
    kind, parts, _ = _geometry(bytes(raw), 0)
    return {POINT: "Point", POLYGON: "Polygon", MULTIPOLYGON: "MultiPolygon"}[kind], parts


def bounds_of(raw: bytes) -> tuple[float, float, float, float] | None:
    points = [p for part in parse(raw)[1] for ring in part for p in ring]
    if not points:
        return None
    xs, ys = zip(*points, strict=True)
    return min(xs), min(ys), max(xs), max(ys)


@F.pandas_udf(T.StructType().add("geometry_type", T.StringType()).add("polygons", T.ArrayType(T.ArrayType(T.ArrayType(T.StructType().add("x", T.DoubleType()).add("y", T.DoubleType()))))))
def shapes(raw: pd.Series) -> pd.DataFrame:
    """The type and polygons of a column of well-known binary; null gives nulls."""
    found = [(None, None) if r is None else parse(r) for r in raw]
    as_rows = lambda parts: None if parts is None else [[[{"x": x, "y": y} for x, y in ring] for ring in part] for part in parts]
    return pd.DataFrame({"geometry_type": [k for k, _ in found], "polygons": [as_rows(p) for _, p in found]})
