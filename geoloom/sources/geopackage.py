"""GeoPackage feature tables as a Spark data source, with boxes pushed into the file's R-tree and unread columns left out.

Options: path, layer (the only feature table if unset), bbox ("minx,miny,maxx,maxy", touching counts), columns
("a,b", all if unset; a missing one is an error), rowsPerPartition. Rows carry the feature's id, its attributes, the
bounds of its geometry, its well-known binary and the code of its system. Null and empty geometries have null bounds.
"""

from __future__ import annotations

import sqlite3
import struct
from collections.abc import Iterator
from contextlib import closing
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import BinaryType, DoubleType, LongType, StringType, StructType

from geoloom.functions.wkb import bounds_of

ROWS_A_PARTITION = 100_000
SIDES = ("minx", "miny", "maxx", "maxy")
# Bytes of the envelope by its code in the header's flags.
ENVELOPE = {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}


def _open(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def split_blob(blob: bytes | None) -> tuple[tuple[float, ...] | None, bytes | None]:
    """(bounds, well-known binary) of a geometry blob; bounds are null where the header has no envelope."""
    if not blob:
        return None, None
    if blob[:2] != b"GP":
        raise ValueError("no GeoPackage geometry")
    order, size = "<" if blob[3] & 1 else ">", ENVELOPE[blob[3] >> 1 & 7]
    bounds = None
    if size and not blob[3] & 16:
        minx, maxx, miny, maxy = struct.unpack_from(order + "4d", blob, 8)
        bounds = (minx, miny, maxx, maxy)
    return bounds, blob[8 + size :]


@dataclass(frozen=True)
class Layer:
    """What the file's catalogue says of a feature table."""

    table: str
    geometry: str
    key: str
    crs: str
    columns: tuple[tuple[str, str], ...]
    indexed: bool


def read_layer(path: str, name: str | None = None) -> Layer:
    with closing(_open(path)) as db:
        tables = [r for r in db.execute("SELECT g.table_name, column_name, organization || ':' || organization_coordsys_id FROM gpkg_geometry_columns g JOIN gpkg_spatial_ref_sys s USING (srs_id) ORDER BY 1") if name in (None, r[0])]
        if len(tables) != 1:
            raise ValueError(f"{path} has {len(tables)} feature tables" + (f" named {name}" if name else "; name one with the option layer"))
        table, geometry, crs = tables[0]
        described = db.execute(f"PRAGMA table_info({_quoted(table)})").fetchall()
        key = next((r[1] for r in described if r[5]), "rowid")
        indexed = db.execute("SELECT 1 FROM sqlite_master WHERE name = ?", (f"rtree_{table}_{geometry}",)).fetchone()
        return Layer(table, geometry, key, crs, tuple((r[1], r[2].upper()) for r in described if r[1] not in (key, geometry)), bool(indexed))


@dataclass
class Rows(InputPartition):
    first: int
    last: int


class GeoPackageReader(DataSourceReader):
    def __init__(self, options: dict, columns: list[str]):
        self.path, self.layer, self.columns = options["path"], read_layer(options["path"], options.get("layer")), columns
        self.box = tuple(map(float, options["bbox"].split(","))) if options.get("bbox") else None
        self.size = int(options.get("rowsPerPartition", ROWS_A_PARTITION))

    def partitions(self) -> list[Rows]:
        with closing(_open(self.path)) as db:
            low, high = db.execute(f"SELECT min({_quoted(self.layer.key)}), max({_quoted(self.layer.key)}) FROM {_quoted(self.layer.table)}").fetchone()
        return [Rows(k, k + self.size) for k in range(low, high + 1, self.size)] if low is not None else [Rows(0, 0)]

    def read(self, rows: Rows) -> Iterator[tuple]:
        layer, key = self.layer, _quoted(self.layer.key)
        where, values = f"t.{key} >= ? AND t.{key} < ?", [rows.first, rows.last]
        source = f"{_quoted(layer.table)} t"
        if self.box and layer.indexed:
            minx, miny, maxx, maxy = self.box
            source += f" JOIN {_quoted(f'rtree_{layer.table}_{layer.geometry}')} r ON r.id = t.{key}"
            where, values = where + " AND r.maxx >= ? AND r.minx <= ? AND r.maxy >= ? AND r.miny <= ?", [*values, minx, maxx, miny, maxy]
        items = ", ".join(f"t.{_quoted(c)}" for c in (layer.key, *self.columns, layer.geometry))
        with closing(_open(self.path)) as db:
            for fid, *attributes, blob in db.execute(f"SELECT {items} FROM {source} WHERE {where}", values):
                bounds, wkb = split_blob(blob)
                if wkb and bounds is None:
                    bounds = bounds_of(wkb)
                # the tree holds bounds rounded outwards, and a table may have none
                if self.box and (bounds is None or not (bounds[2] >= self.box[0] and bounds[0] <= self.box[2] and bounds[3] >= self.box[1] and bounds[1] <= self.box[3])):
                    continue
                yield fid, *(a if a is None or isinstance(a, (int, float, bytes)) else str(a) for a in attributes), *(bounds or (None,) * 4), wkb, layer.crs


class GeoPackageSource(DataSource):
    """spark.dataSource.register(GeoPackageSource); spark.read.format("geopackage").load("/catalogue.gpkg")"""

    @classmethod
    def name(cls) -> str:
        return "geopackage"

    def _columns(self) -> list[tuple[str, str]]:
        layer = read_layer(self.options["path"], self.options.get("layer"))
        named = [c for c in self.options.get("columns", "").split(",") if c]
        if missing := sorted(set(named) - {c for c, _ in layer.columns}):
            raise ValueError(f"{layer.table} has no columns {missing}")
        kinds = dict(layer.columns)
        return [(c, kinds[c]) for c in named] if named else list(layer.columns)

    def schema(self) -> StructType:
        out = StructType().add("fid", LongType())
        for column, kind in self._columns():
            out.add(column, LongType() if "INT" in kind else DoubleType() if kind in ("REAL", "DOUBLE", "FLOAT") else BinaryType() if kind.startswith("BLOB") else StringType())
        for side in SIDES:
            out.add(side, DoubleType())
        return out.add("wkb", BinaryType()).add("crs", StringType())

    def reader(self, schema) -> GeoPackageReader:
        return GeoPackageReader(self.options, [c for c, _ in self._columns()])
