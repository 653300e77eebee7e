"""GeoTIFF: a writer, headers, and a data source with a partition for each tile or strip.

Tiles and strips, either byte order, plain, LZW or deflated, with predictors, bands apart or together. Offsets have 32
bits, and rasters lie along the axes.
"""

from __future__ import annotations

import glob
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

TILE = 256
SCHEMA = "raster_id string, row int, col int, value double"
# TIFF tags and the sizes of field types.
WIDTH, HEIGHT, BITS, COMPRESSION, SAMPLES, PLANAR, PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS, FORMAT = 256, 257, 258, 259, 277, 284, 317, 322, 323, 324, 325, 339
STRIP_OFFSETS, STRIP_ROWS, STRIP_COUNTS, SCALE, TIE, GEO_KEYS, NODATA, METADATA, SUBFILE = 273, 278, 279, 33550, 33922, 34735, 42113, 42112, 254
GEOGRAPHIC_KEY, PROJECTED_KEY = 2048, 3072
FIELD = {1: "B", 2: "c", 3: "H", 4: "I", 12: "d", 16: "Q"}


def _tiles(layers: np.ndarray, fill: float) -> list[bytes]:
    bands, height, width = layers.shape
    down, across = -(-height // TILE), -(-width // TILE)
    padded = np.full((bands, down * TILE, across * TILE), fill, layers.dtype)
    padded[:, :height, :width] = layers
    return [zlib.compress(padded[b, r * TILE : (r + 1) * TILE, c * TILE : (c + 1) * TILE].tobytes()) for b in range(bands) for r in range(down) for c in range(across)]


def _directory(entries: list[tuple], at: int, following: int) -> tuple[bytes, int]:
    """A directory that begins at a place, and where it ends; following is the place of the next, relative to that end, or -1."""
    extra, table = b"", struct.pack("<H", len(entries))
    spare = at + 2 + 12 * len(entries) + 4
    for tag, kind, data in entries:
        raw = data if kind == 2 else struct.pack(f"<{len(data)}{FIELD[kind]}", *data)
        field = raw.ljust(4, b"\0") if len(raw) <= 4 else struct.pack("<I", spare + len(extra))
        extra += raw if len(raw) > 4 else b""
        table += struct.pack("<HHI", tag, kind, len(data)) + field
    end = spare + len(extra)
    return table + struct.pack("<I", 0 if following < 0 else end + following) + extra, end


def write_geotiff(path: str, values: np.ndarray, left: float, top: float, pixel: float, nodata: float | None = float("nan"), epsg: int | None = None, pixel_y: float | None = None, tags: dict[str, str] | None = None, mask: np.ndarray | None = None) -> None:
    """256-pixel deflated tiles, written beside their place and renamed.

    values is (rows, columns) or (bands, rows, columns); bytes stay bytes, all else becomes float32. Bands lie apart.
    epsg names a projected system, or a geographic one below 5000 from 4000 on. tags are kept as metadata of the raster; mask tells
    cells that hold a value, in a directory of its own.
    """
    layers = values[None] if values.ndim == 2 else values
    layers = layers if layers.dtype == np.uint8 else layers.astype(np.float32)
    bands, height, width = layers.shape
    tiles = _tiles(layers, 0 if nodata is None or layers.dtype == np.uint8 else nodata)
    masks = [] if mask is None else _tiles(np.where(mask, 255, 0).astype(np.uint8)[None], 0)
    at = (8 + np.concatenate([[0], np.cumsum([len(t) for t in (*tiles, *masks)])])).tolist()
    bits = 8 * layers.dtype.itemsize
    entries = [(WIDTH, 4, [width]), (HEIGHT, 4, [height]), (BITS, 3, [bits] * bands), (COMPRESSION, 3, [8]), (262, 3, [2 if bands == 3 else 1]), (SAMPLES, 3, [bands]), (PLANAR, 3, [2 if bands > 1 else 1]), (TILE_WIDTH, 3, [TILE]), (TILE_HEIGHT, 3, [TILE]), (TILE_OFFSETS, 4, at[: len(tiles)]), (TILE_COUNTS, 4, [len(t) for t in tiles]), (FORMAT, 3, [1 if bits == 8 else 3] * bands), (SCALE, 12, [pixel, pixel if pixel_y is None else pixel_y, 0.0]), (TIE, 12, [0.0, 0.0, 0.0, left, top, 0.0])]
    if epsg is not None:
        geographic = 4000 <= epsg < 5000
        entries.append((GEO_KEYS, 3, [1, 1, 0, 2, 1024, 0, 1, 2 if geographic else 1, GEOGRAPHIC_KEY if geographic else PROJECTED_KEY, 0, 1, epsg]))
    if tags:
        items = "".join(f'<Item name="{escape(k, {chr(34): "&quot;"})}">{escape(v)}</Item>' for k, v in sorted(tags.items()))
        entries.append((METADATA, 2, f"<GDALMetadata>{items}</GDALMetadata>\0".encode()))
    if nodata is not None:
        entries.append((NODATA, 2, (repr(float(nodata)) + "\0").encode()))
    first, end = _directory(entries, at[-1], 0 if masks else -1)
    second = b""
    if masks:
        second, _ = _directory([(SUBFILE, 4, [4]), (WIDTH, 4, [width]), (HEIGHT, 4, [height]), (BITS, 3, [8]), (COMPRESSION, 3, [8]), (262, 3, [4]), (SAMPLES, 3, [1]), (PLANAR, 3, [1]), (TILE_WIDTH, 3, [TILE]), (TILE_HEIGHT, 3, [TILE]), (TILE_OFFSETS, 4, at[len(tiles) : -1]), (TILE_COUNTS, 4, [len(t) for t in masks]), (FORMAT, 3, [1])], end, -1)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with open(part, "wb") as f:
        f.write(b"II*\0" + struct.pack("<I", at[-1]) + b"".join(tiles) + b"".join(masks) + first + second)
    os.replace(part, path)


def _directories(path: str) -> Iterator[dict[int, tuple]]:
    """The headers in a file, each with the byte order under 0; no pixel is read."""
    with open(path, "rb") as f:
        order = {b"II*\0": "<", b"MM\0*": ">"}.get(f.read(4))
        if order is None:
            raise ValueError(f"{path} is no TIFF of 32-bit offsets")
        place, seen = struct.unpack(order + "I", f.read(4))[0], set()
        while place and place not in seen:
            seen.add(place)
            f.seek(place)
            raw = f.read(12 * struct.unpack(order + "H", f.read(2))[0])
            last = f.read(4)
            tags: dict[int, tuple] = {0: (order,)}
            for at in range(0, len(raw), 12):
                tag, kind, count = struct.unpack_from(order + "HHI", raw, at)
                if kind not in FIELD:
                    continue
                form = f"{order}{count}{FIELD[kind]}"
                size = struct.calcsize(form)
                if size > 4:
                    f.seek(struct.unpack_from(order + "I", raw, at + 8)[0])
                tags[tag] = struct.unpack(form, f.read(size) if size > 4 else raw[at + 8 : at + 8 + size])
            if STRIP_OFFSETS in tags:  # a strip is a tile as wide as the raster
                tags[TILE_OFFSETS], tags[TILE_COUNTS], tags[TILE_WIDTH] = tags[STRIP_OFFSETS], tags[STRIP_COUNTS], tags[WIDTH]
                tags[TILE_HEIGHT] = (min(tags.get(STRIP_ROWS, tags[HEIGHT])[0], tags[HEIGHT][0]),)
            yield tags
            place = struct.unpack(order + "I", last)[0] if len(last) == 4 else 0


def read_tags(path: str) -> dict[int, tuple]:
    return next(_directories(path))


def mask_tags(path: str) -> dict[int, tuple] | None:
    """The header of the mask of the full raster, if there is one that is cut into the same tiles."""
    first, *others = _directories(path)
    for tags in others:
        if tags.get(SUBFILE, (0,))[0] & 4 and all(tags.get(k) == first.get(k) for k in (WIDTH, HEIGHT, TILE_WIDTH, TILE_HEIGHT)) and tags[BITS][0] == 8:
            return tags
    return None


def read_metadata(path: str) -> dict[str, str]:
    """The metadata that write_geotiff's tags became."""
    found = read_tags(path).get(METADATA)
    if not found:
        return {}
    root = ElementTree.fromstring(b"".join(found).rstrip(b"\0").decode())
    return {item.get("name"): item.text or "" for item in root.iter("Item")}


@dataclass(frozen=True)
class Header:
    width: int
    height: int
    bands: int
    bounds: tuple[float, float, float, float]
    pixel: tuple[float, float]
    crs: str | None


def read_header(path: str) -> Header:
    """Size, place and system of a raster that lies along the axes."""
    tags = read_tags(path)
    if SCALE not in tags or TIE not in tags:
        raise ValueError(f"{path} is not placed by one point and a scale")
    width, height, (sx, sy, _), (col, row, _, x, y, _) = tags[WIDTH][0], tags[HEIGHT][0], tags[SCALE], tags[TIE][:6]
    left, top = x - col * sx, y + row * sy
    keys = tags.get(GEO_KEYS, ())
    codes = {keys[k]: keys[k + 3] for k in range(4, len(keys), 4) if keys[k + 1] == 0}
    code = codes.get(PROJECTED_KEY) or codes.get(GEOGRAPHIC_KEY)
    return Header(width, height, tags.get(SAMPLES, (1,))[0], (left, top - height * sy, left + width * sx, top), (sx, sy), f"EPSG:{code}" if code else None)


def unpack_lzw(raw: bytes) -> bytes:
    """The TIFF kind: codes from the high bit on, widened one entry early; 256 clears and 257 ends."""
    fresh = [bytes([k]) for k in range(256)] + [b"", b""]
    table, out, last = list(fresh), [], b""
    held = bits = 0
    wide = 9
    for byte in raw:
        held, bits = held << 8 | byte, bits + 8
        if bits < wide:
            continue
        bits -= wide
        code, held = held >> bits, held & (1 << bits) - 1
        if code == 257:
            break
        if code == 256:
            table, last, wide = list(fresh), b"", 9
            continue
        entry = table[code] if code < len(table) else last + last[:1]
        out.append(entry)
        if last:
            table.append(last + entry[:1])
        last = entry
        wide = max(9, min(12, (len(table) + 1).bit_length()))
    return b"".join(out)


def read_block(path: str, tags: dict[int, tuple], offset: int, count: int) -> np.ndarray:
    """The (rows, columns, samples) of a tile or strip, of one sample where bands lie apart; the last strip may be short."""
    with open(path, "rb") as f:
        f.seek(offset)
        raw = f.read(count)
    packed = tags.get(COMPRESSION, (1,))[0]
    if packed not in (1, 5, 8, 32946):
        raise ValueError(f"{path} has compression {packed}")
    raw = raw if packed == 1 else unpack_lzw(raw) if packed == 5 else zlib.decompress(raw)
    form, bits, wide = tags.get(FORMAT, (1,))[0], tags[BITS][0], tags[TILE_WIDTH][0]
    kind = np.dtype(tags[0][0] + {1: "u", 2: "i", 3: "f"}[form] + str(bits // 8))
    samples = tags.get(SAMPLES, (1,))[0] if tags.get(PLANAR, (1,))[0] == 1 else 1
    rows = len(raw) // (wide * samples * kind.itemsize)
    block = np.frombuffer(raw, kind, rows * wide * samples).reshape(rows, wide, samples)
    predictor = tags.get(PREDICTOR, (1,))[0]
    if predictor == 2:
        return np.cumsum(block, axis=1, dtype=kind.newbyteorder("="))
    if predictor == 3:  # bytes of each place together, high ones first, each the difference to the one before
        planes = np.cumsum(np.frombuffer(raw, np.uint8, block.nbytes).reshape(rows, -1, samples), axis=1, dtype=np.uint8)
        return np.ascontiguousarray(planes.reshape(rows, kind.itemsize, wide * samples).transpose(0, 2, 1)).view(kind.newbyteorder(">")).reshape(rows, wide, samples)
    return block


@dataclass
class Tile(InputPartition):
    path: str
    row: int
    col: int
    offset: int
    count: int


def tiles_of(path: str, band: int = 1) -> list[Tile]:
    """The tiles or strips of a band."""
    tags = read_tags(path)
    if not 1 <= band <= tags.get(SAMPLES, (1,))[0]:
        raise ValueError(f"{path} has no band {band}")
    high, wide = tags[TILE_HEIGHT][0], tags[TILE_WIDTH][0]
    across, down = -(-tags[WIDTH][0] // wide), -(-tags[HEIGHT][0] // high)
    first = (band - 1) * across * down if tags.get(PLANAR, (1,))[0] == 2 else 0
    blocks = list(zip(tags[TILE_OFFSETS], tags[TILE_COUNTS], strict=True))[first : first + across * down]
    return [Tile(path, k // across * high, k % across * wide, o, n) for k, (o, n) in enumerate(blocks)]


def read_tile(tile: Tile, band: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """row, col, value and whether it is none, of a tile's cells: not a number, the marker of no data, or off the mask."""
    tags = read_tags(tile.path)
    block = read_block(tile.path, tags, tile.offset, tile.count)
    values = block[: tags[HEIGHT][0] - tile.row, : tags[WIDTH][0] - tile.col, band - 1 if block.shape[2] > 1 else 0].astype(float)
    marker = float(b"".join(tags[NODATA]).rstrip(b"\0 ")) if NODATA in tags else np.nan
    bad = np.isnan(values) | (values == marker)
    if (masked := mask_tags(tile.path)) is not None:
        across = -(-tags[WIDTH][0] // tags[TILE_WIDTH][0])
        k = tile.row // tags[TILE_HEIGHT][0] * across + tile.col // tags[TILE_WIDTH][0]
        bad |= read_block(tile.path, masked, masked[TILE_OFFSETS][k], masked[TILE_COUNTS][k])[: values.shape[0], : values.shape[1], 0] == 0
    rows, cols = np.mgrid[tile.row : tile.row + values.shape[0], tile.col : tile.col + values.shape[1]]
    return rows.ravel().astype(np.int32), cols.ravel().astype(np.int32), values.ravel(), bad.ravel()


class GeoTiffReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths, self.band = sorted(glob.glob(options["path"])), int(options.get("band", 1))

    def partitions(self) -> list[Tile]:
        return [t for p in self.paths for t in tiles_of(p, self.band)] or [Tile("", 0, 0, 0, 0)]

    def read(self, tile: Tile) -> Iterator[pa.RecordBatch]:
        if not tile.count:
            return
        rows, cols, values, bad = read_tile(tile, self.band)
        name = pa.array([tile.path.rpartition("/")[2].rpartition(".")[0]] * values.size, pa.string())
        yield pa.RecordBatch.from_arrays([name, pa.array(rows), pa.array(cols), pa.array(values, mask=bad)], names=["raster_id", "row", "col", "value"])


class GeoTiffSource(DataSource):
    """spark.dataSource.register(GeoTiffSource); spark.read.format("geotiff_cells").option("band", 1).load("/rasters/*.tif")"""

    @classmethod
    def name(cls) -> str:
        return "geotiff_cells"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> GeoTiffReader:
        return GeoTiffReader(self.options)
