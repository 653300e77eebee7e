"""Members of ZIP archives: which to take, and taking them, one archive a task row."""

from __future__ import annotations

import os
import shutil
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

# Parts of names that tell previews, and how rasters of elevation end.
PREVIEWS = ("preview", "quicklook", "/aux/", "overview")
RASTERS = ("dem.tif", "dem.tiff", "dem.dt1", "dem.dt2")
RESULT = "key string, archive string, path string, error string"


def elevation_member(names: list[str], tile: str) -> str:
    """The raster of elevation: one that names the tile before others, then the least deep, then the first."""
    fit = [n for n in names if n.lower().endswith(RASTERS) and not any(p in n.lower() for p in PREVIEWS)]
    if not fit:
        raise ValueError("no elevation raster in the archive")
    return min(fit, key=lambda n: (tile.lower() not in n.lower(), n.count("/")))


def sheet_members(names: list[str], stem: str, primary: str, sidecars: tuple[str, ...] = ()) -> list[tuple[str, str]]:
    """(member, published name), sidecars first, the primary last: exact stem and suffix, whatever the case and folder."""
    by_suffix: dict[str, str] = {}
    for name in names:
        base = name.replace("\\", "/").rpartition("/")[2].lower()
        suffix = base.removeprefix(stem.lower()) if base.startswith(stem.lower()) else None
        if suffix in (*sidecars, primary):
            if suffix in by_suffix:
                raise ValueError(f"two members end in {suffix}")
            by_suffix[suffix] = name
    if primary not in by_suffix:
        raise ValueError(f"no member {stem}{primary}")
    return [(by_suffix[s], stem + s) for s in (*sidecars, primary) if s in by_suffix]


def _publish(archive: zipfile.ZipFile, chosen: list[tuple[str, str]], folder: str) -> str:
    """Members under names of our own, never the archive's, so that none can leave the folder; all are read before any appears."""
    os.makedirs(folder, exist_ok=True)
    ready = []
    try:
        for member, name in chosen:
            if name != os.path.basename(name) or name in ("", ".", ".."):
                raise ValueError(f"{name!r} cannot be a file name")
            part = os.path.join(folder, f"{name}.{uuid.uuid4().hex}.part")
            ready.append((part, os.path.join(folder, name)))
            with archive.open(member) as source, open(part, "wb") as target:
                shutil.copyfileobj(source, target, 1 << 20)
        for part, place in ready:
            os.replace(part, place)
        return ready[-1][1]
    finally:
        for part, _ in ready:
            if os.path.exists(part):
                os.remove(part)


def unpack(path: str, folder: str, choose: Callable[[list[str]], list[tuple[str, str]]]) -> str:
    """One archive: publishes the members that choose names, and gives the path of the last. A broken one is an error."""
    try:
        with zipfile.ZipFile(path) as archive:
            return _publish(archive, choose(archive.namelist()), folder)
    except zipfile.BadZipFile as broken:
        raise ValueError(f"{path} is no archive") from broken


def extract(archives: DataFrame, folder: str, kind: str = "elevation", suffix: str = "copdem", primary: str = ".tif", sidecars: tuple[str, ...] = ()) -> DataFrame:
    """(key, archive, path, error) of a frame (key, archive): kind elevation publishes <key>_<suffix>, kind sheet <key><primary>.

    Files are streamed in pieces of a megabyte. A broken or unfit archive gives an error and publishes nothing. A task
    that runs again publishes the same bytes.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for key, path in zip(frame["key"], frame["archive"], strict=True):
                try:
                    with zipfile.ZipFile(path) as archive:
                        if kind == "elevation":
                            member = elevation_member(archive.namelist(), key)
                            chosen = [(member, f"{key}_{suffix}{os.path.splitext(member)[1]}")]
                        else:
                            chosen = sheet_members(archive.namelist(), key, primary, sidecars)
                        out.append((key, path, _publish(archive, chosen, folder), None))
                except (OSError, ValueError, zipfile.BadZipFile) as e:
                    out.append((key, path, None, str(e)))
            yield pd.DataFrame(out, columns=["key", "archive", "path", "error"])

    return archives.select("key", "archive").mapInPandas(run, RESULT)
