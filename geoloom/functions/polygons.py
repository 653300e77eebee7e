"""Polygon areas and intersections, by signed triangle fans clipped against each other."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

Point = tuple[float, float]


def signed_area(ring: list[Point]) -> float:
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, [*ring[1:], ring[0]], strict=True)) / 2 if ring else 0.0


def area(rings: list[list[Point]]) -> float:
    """The first ring less the others."""
    return abs(signed_area(rings[0])) - sum(abs(signed_area(r)) for r in rings[1:]) if rings else 0.0


def centroid(rings: list[list[Point]]) -> Point:
    total = x = y = 0.0
    for k, ring in enumerate(rings):
        sign = (1 if k == 0 else -1) * (1 if signed_area(ring) >= 0 else -1)
        for a, b in zip(ring, [*ring[1:], ring[0]], strict=True):
            cross = sign * (a[0] * b[1] - b[0] * a[1])
            total, x, y = total + cross, x + (a[0] + b[0]) * cross, y + (a[1] + b[1]) * cross
    return (x / (3 * total), y / (3 * total))


def clip(subject: list[Point], convex: list[Point]) -> list[Point]:
    """The part of a convex polygon within another one that turns left (Sutherland and Hodgman)."""
    out = subject
    for a, b in zip(convex, [*convex[1:], convex[0]], strict=True):
        if not out:
            break
        side = [(b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0]) for p in out]
        kept: list[Point] = []
        for p, q, s, t in zip(out, [*out[1:], out[0]], side, [*side[1:], side[0]], strict=True):
            if s >= 0:
                kept.append(p)
            if (s > 0 > t) or (s < 0 < t):
                w = s / (s - t)
                kept.append((p[0] + (q[0] - p[0]) * w, p[1] + (q[1] - p[1]) * w))
        out = kept
    return out


def _fans(rings: list[list[Point]]) -> Iterator[tuple[float, list[Point]]]:
    for k, ring in enumerate(rings):
        turn = 1 if signed_area(ring) >= 0 else -1
        for b, c in zip(ring[1:], ring[2:], strict=False):
            fan = [ring[0], b, c]
            own = signed_area(fan)
            if own:
                yield (1 if k == 0 else -1) * turn * (1 if own > 0 else -1), fan if own > 0 else fan[::-1]


def _as_box(rings: list[list[Point]]) -> tuple[float, float, float, float] | None:
    """The sides of a polygon that is a box along the axes, null for others."""
    if len(rings) != 1:
        return None
    ring = rings[0][:-1] if len(rings[0]) == 5 and rings[0][0] == rings[0][-1] else rings[0]
    xs, ys = {p[0] for p in ring}, {p[1] for p in ring}
    if len(ring) != 4 or len(xs) != 2 or len(ys) != 2 or len(set(ring)) != 4 or any((p[0] == q[0]) == (p[1] == q[1]) for p, q in zip(ring, ring[1:], strict=False)):
        return None
    return min(xs), min(ys), max(xs), max(ys)


def intersection_area(a: list[list[Point]], b: list[list[Point]]) -> float:
    """Shared area of two polygons with holes, convex or not."""
    p, q = _as_box(a), _as_box(b)
    if p and q:
        return max(0.0, min(p[2], q[2]) - max(p[0], q[0])) * max(0.0, min(p[3], q[3]) - max(p[1], q[1]))
    other = list(_fans(b))
    return sum(s * t * abs(signed_area(clip(p, q))) for s, p in _fans(a) for t, q in other)


def box_ring(minx: float, miny: float, maxx: float, maxy: float) -> list[Point]:
    return [(minx, miny), (maxx, miny), (maxx, maxy), (minx, maxy)]


def _rings(value) -> list[list[Point]]:
    return [[(p["x"], p["y"]) for p in ring] for ring in value]


@F.pandas_udf(T.DoubleType())
def polygon_area(rings: pd.Series) -> pd.Series:
    return rings.map(lambda r: None if r is None else area(_rings(r)))


@F.pandas_udf(T.DoubleType())
def shared_area(a: pd.Series, b: pd.Series) -> pd.Series:
    """Area of the intersection of two columns of array<array<struct<x:double,y:double>>>."""
    return pd.Series(np.array([np.nan if x is None or y is None else intersection_area(_rings(x), _rings(y)) for x, y in zip(a, b, strict=True)]))


def union_area(a: str, b: str):
    """Area of what either of two polygon columns covers."""
    return polygon_area(a) + polygon_area(b) - shared_area(a, b)


def difference_area(a: str, b: str):
    """Area of what the first of two polygon columns covers and the second does not."""
    return polygon_area(a) - shared_area(a, b)


def _coordinate(rings, axis: int):
    return F.transform(F.flatten(rings), lambda p: p["x"] if axis == 0 else p["y"])


def bounds(rings: str) -> list:
    """minx, miny, maxx, maxy of a polygon column."""
    r = F.col(rings)
    return [F.array_min(_coordinate(r, 0)), F.array_min(_coordinate(r, 1)), F.array_max(_coordinate(r, 0)), F.array_max(_coordinate(r, 1))]


@F.pandas_udf(T.StructType().add("x", T.DoubleType()).add("y", T.DoubleType()))
def polygon_centroid(rings: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([(None, None) if r is None else centroid(_rings(r)) for r in rings], columns=["x", "y"], dtype=object)
