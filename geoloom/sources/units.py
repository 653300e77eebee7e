"""Work units with lists of links: the cache of lists, the plan of point clouds and elevation tiles, samples of headers, replays of audits."""

from __future__ import annotations

import hashlib
import os
import re
import time
import urllib.request
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.functions import filenames, grids
from geoloom.functions.text import basename, extension, normalized_link, suffixed, url_path
from geoloom.operators import alignment, boxes, naming, planning
from geoloom.sources.download import fetch
from geoloom.sources.las import parse_header

LIST = "0_file_download_links.txt"
#: Bytes that a complete catalogue of work units has at least, and those of a file's head that a sample reads.
LEAST_CATALOGUE, HEAD = 3 << 30, 512 << 10
#: Side of an elevation tile.
TILE = 10_000.0
DAY = 86400.0

Get = Callable[[str], str]


def get_text(url: str) -> str:
    with urllib.request.urlopen(url, timeout=120) as answer:
        return answer.read().decode("utf-8", "replace")


def offline(url: str) -> str:
    """For replays: nothing is fetched."""
    raise OSError(f"{url} is not in the cache")


def ensure_catalogue(url: str, path: str, least: int = LEAST_CATALOGUE, **attempts) -> str:
    """The catalogue of work units, fetched if it is not whole. What a broken run left under the final name is gone on from."""
    if os.path.isfile(path) and os.path.getsize(path) >= least:
        return path
    part = path + ".part"
    if os.path.isfile(path) and not os.path.isfile(part):
        os.replace(path, part)
    fetch(url, path, **attempts)
    if os.path.getsize(path) < least:
        os.replace(path, part)
        raise ValueError(f"{path} has {os.path.getsize(part)} bytes, a whole catalogue {least}")
    return path


def cache_name(url: str) -> str:
    """The file of a list in the cache: the folder above it and eight digits of the whole link."""
    above = re.sub(r"[^\w.-]", "_", url.rstrip("/").split("/")[-2])
    return f"{above}_{hashlib.md5(url.encode()).hexdigest()[:8]}.txt"


def cached_text(url: str, folder: str, days: float = 10.0, get: Get = get_text, now: Callable[[], float] = time.time) -> str:
    """A list of links, from the cache if it is fresh. Writers may race: each has a file of its own, and the last one to be whole stays."""
    path = os.path.join(folder, cache_name(url))
    if get is offline or os.path.isfile(path) and now() - os.path.getmtime(path) < days * DAY:
        if not os.path.isfile(path):
            return get(url)
        with open(path, encoding="utf-8") as f:
            return f.read()
    text = get(url)
    os.makedirs(folder, exist_ok=True)
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    with open(part, "w", encoding="utf-8") as f:
        f.write(text)
    os.replace(part, path)
    return text


def link_lists(units: DataFrame, url: str, folder: str, days: float = 10.0, get: Get = get_text, workers: int = 4) -> DataFrame:
    """(link, error) with a row per line of the lists of units, each list read once: (list_url, link, error), link null where a list cannot be read. folder is one that all executors share."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for own in frame["list_url"]:
                try:
                    lines = [(own, line, None) for line in cached_text(own, folder, days, get).splitlines() if line.strip()]
                except (OSError, ValueError) as e:
                    lines = [(own, None, f"cannot read {own}: {e}")]
                yield pd.DataFrame(lines, columns=["list_url", "link", "error"])

    wanted = units.where(F.col(url).isNotNull()).select(F.col(url).alias("list_url")).distinct()
    return wanted.repartition(workers, "list_url").mapInPandas(run, "list_url string, link string, error string")


def named_links(links: DataFrame, extensions: list[str]) -> DataFrame:
    """Links of files with one of the extensions: repaired, with the file's name and place in its list."""
    fixed = links.withColumn("url", normalized_link(F.trim("link"))).withColumn("filename", basename(url_path(F.col("url"))))
    return fixed.where(extension(F.col("filename")).isin(*extensions))


def cloud_files(links: DataFrame) -> DataFrame:
    """(list_url, filename, url, placeholder, n): point clouds of lists, each name once with its first link, and how often it stands there."""
    named = named_links(links.withColumn("at", F.monotonically_increasing_id()), [".las", ".laz"])
    once = named.groupBy("list_url", "filename").agg(F.min_by("url", "at").alias("url"), F.count(F.lit(1)).alias("n"))
    return once.withColumn("placeholder", F.coalesce(filenames.placeholder(F.col("filename")), F.lit(False)))


def _kinds_met(regions: DataFrame, units: DataFrame, size: float) -> tuple[DataFrame, DataFrame]:
    """(l_kind, unit columns): work units whose box touches one of a kind of regions; and the regions of each kind, as boxes.alike has them."""
    kinds, listed = boxes.alike(boxes.prefixed(regions, "l_"))
    rest = [c for c in units.columns if c not in boxes.SIDES]
    met = boxes.box_join(kinds, boxes.prefixed(units.distinct(), "r_"), size, touch=True)
    return met.select("l_kind", *(F.col(f"r_{c}").alias(c) for c in rest)).distinct(), listed


def units_of_regions(regions: DataFrame, units: DataFrame, size: float) -> DataFrame:
    """(region_id, unit columns): work units whose box touches a region's; both in degrees, where the two usual datums count as one."""
    met, listed = _kinds_met(regions, units, size)
    rest = [c for c in units.columns if c not in boxes.SIDES]
    return met.join(listed, "l_kind").select(F.col("l_region_id").alias("region_id"), *rest)


def unit_targets(regions: DataFrame, units: DataFrame, size: float) -> DataFrame:
    """(unit columns, regions): how many regions the box of each work unit touches, without a list of them."""
    met, listed = _kinds_met(regions, units, size)
    rest = [c for c in units.columns if c not in boxes.SIDES]
    return met.join(listed.groupBy("l_kind").agg(F.count("l_region_id").alias("_n")), "l_kind").groupBy(*rest).agg(F.sum("_n").alias("regions"))


def ordered_units(met: DataFrame) -> DataFrame:
    """Each work unit once (lpc_link, workunit) with all its regions, newest first: rank is unique."""
    rest = [c for c in met.columns if c not in ("region_id", "lpc_link", "workunit")]
    unit = [F.coalesce(c, F.lit("")).alias(c) for c in ("lpc_link", "workunit")]
    once = met.groupBy(*unit).agg(F.min(F.struct(*rest)).alias("_u"), F.array_sort(F.collect_set("region_id")).alias("regions")).select("lpc_link", "workunit", "_u.*", "regions")
    return planning.ranked(once.withColumn("ordinal", F.concat_ws("|", "lpc_link", "workunit")), "collect_end", "ordinal").drop("ordinal")


def planned_clouds(units: DataFrame, links: DataFrame, rules: list[naming.Rule]) -> DataFrame:
    """Files of work units (lpc_link, workunit, project, horiz_crs) with the box that a rule reads from the name: naming.plan_tiles' rows with url, n and error."""
    listed = units.withColumn("list_url", F.when(F.length("lpc_link") > 0, F.concat("lpc_link", F.lit("/" + LIST))))
    files = cloud_files(links.where("error is null"))
    lost = links.where("error is not null").select("list_url", "error")
    both = listed.join(files, "list_url", "left").join(lost, "list_url", "left").withColumn("error", F.when(F.col("list_url").isNull(), "the unit has no list").otherwise(F.col("error")))
    return naming.plan_tiles(both, rules)


def select_clouds(planned: DataFrame, regions: DataFrame, units: DataFrame, size: float) -> DataFrame:
    """(region_id, workunit, filename, url, tile_crs, rank, new_area): of files whose box overlaps a region those that newer units do not cover already.

    A tile's box is carried into its region's system; one that shares no more than the tolerance with what is left is not taken."""
    tiles = planned.where("minx is not null and not placeholder").select("lpc_link", "workunit", "filename", "url", "tile_crs", *boxes.SIDES)
    wanted = units.select("lpc_link", "workunit", "rank", F.explode("regions").alias("region_id"))
    near = tiles.join(wanted, ["lpc_link", "workunit"]).join(regions.select("region_id", F.col("crs").alias("region_crs"), *(F.col(s).alias(f"l_{s}") for s in boxes.SIDES)), "region_id")
    moved = alignment.with_envelope(near, "tile_crs", "region_crs")
    pairs = moved.withColumnsRenamed({s: f"r_{s}" for s in boxes.SIDES}).withColumnsRenamed({"region_id": "l_region_id"}).where(boxes.overlap("l_", "r_"))
    found = boxes.newest_first(pairs.withColumnsRenamed({"lpc_link": "r_lpc_link", "workunit": "r_workunit", "filename": "r_filename", "url": "r_url", "tile_crs": "r_tile_crs"}).drop("region_crs"))
    return found.where("selected").select(F.col("l_region_id").alias("region_id"), F.col("r_workunit").alias("workunit"), F.col("r_filename").alias("filename"), F.col("r_url").alias("url"), F.col("r_tile_crs").alias("tile_crs"), "rank", "new_area")


def requests(selected: DataFrame) -> DataFrame:
    """One request a file: the newest unit's link, the regions that want it, the least of which owns it, and how many more links there were."""
    out = selected.groupBy("filename").agg(F.min_by(F.struct(*(c for c in ("url", "workunit", "tile_crs") if c in selected.columns)), F.struct("rank", "url")).alias("_f"), F.array_sort(F.collect_set("region_id")).alias("target_region_ids"), F.min("rank").alias("ordinal"), (F.count_distinct("url") - 1).alias("duplicates"))
    return out.select("filename", "_f.*", F.array_min("target_region_ids").alias("region_id"), "target_region_ids", F.col("ordinal").cast("long").alias("ordinal"), "duplicates")


def unit_audit(planned: DataFrame, units: DataFrame) -> DataFrame:
    """Per work unit what its list held and its names told: counts, the first unread names, the error and matched, partial or unmatched, with its regions."""
    key = ["lpc_link", "workunit"]
    # folded by name first, as in naming.audit
    names = planned.groupBy(*key, "filename").agg(F.max("rule").alias("rule"), F.max("error").alias("error"), F.max("n").alias("n"), F.max("placeholder").alias("placeholder"), F.max(F.col("minx").isNotNull()).alias("read"), F.max("no_system").alias("no_system"))
    real = F.col("filename").isNotNull() & ~F.coalesce("placeholder", F.lit(False))
    lost = real & ~F.coalesce("read", F.lit(False))
    counted = names.groupBy(*key).agg(
        F.max("rule").alias("rule"), F.max("error").alias("_error"), F.count_if(real).alias("files"), F.count_if(real & F.col("read")).alias("parsed"), F.count_if(lost).alias("unmatched"), F.coalesce(F.sum(F.when(real, F.col("n") - 1)), F.lit(0)).alias("duplicates"),
        F.coalesce(F.sum(F.when(F.col("placeholder"), F.col("n"))), F.lit(0)).alias("placeholders"), F.slice(F.array_sort(F.collect_list(F.when(lost, F.col("filename")))), 1, naming.EXAMPLES).alias("examples"), F.max(F.coalesce(F.col("no_system"), F.lit(False))).alias("_no_system"),
    )
    error = F.coalesce("_error", F.when(F.col("rule").isNull(), "no rule fits the unit"), F.when(F.col("_no_system"), "a name was read by a scheme without a system"))
    told = counted.withColumn("error", error).withColumn("status", F.when(F.col("rule").isNull() | error.isNotNull(), "unmatched").when(F.col("unmatched") > 0, "partial").otherwise("matched"))
    rest = [c for c in units.columns if c not in (*key, *boxes.SIDES)]
    return units.select(*key, *rest).join(told.drop("_error", "_no_system"), key, "left").withColumn("status", F.coalesce("status", F.lit("unmatched")))


def write_report(rows: DataFrame, path: str) -> None:
    """A table as JSON lines in a folder that Spark publishes whole."""
    rows.write.mode("overwrite").json(path)


def replay_report(planned: DataFrame, units: DataFrame, regions: DataFrame, selected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(units' audit with how many files of each were selected, states with targets, covered targets and the incomplete ones)."""
    chosen = selected.groupBy("workunit").agg(F.count_distinct("filename").alias("selected"))
    rows = unit_audit(planned, units).join(chosen, "workunit", "left").withColumn("selected", F.coalesce("selected", F.lit(0)))
    gained = selected.groupBy("region_id").agg(F.sum("new_area").alias("covered"))
    area = (F.col("maxx") - F.col("minx")) * (F.col("maxy") - F.col("miny"))
    ratio = F.least(F.lit(1.0), F.coalesce("covered", F.lit(0.0)) / area)
    each = regions.join(gained, "region_id", "left").select("region_id", F.split("region_id", "__")[0].alias("state"), F.round(ratio, 6).alias("ratio"), (ratio >= 1 - 1e-6).alias("full"))
    states = each.groupBy("state").agg(F.count(F.lit(1)).alias("targets"), F.count_if("full").alias("covered"), F.array_sort(F.collect_list(F.when(~F.col("full"), F.struct("region_id", "ratio")))).alias("incomplete"))
    return rows, states


# Elevation tiles


def elevation_tiles(links: DataFrame, regions: DataFrame, met: DataFrame, suffix: str | None = None, north: bool = True) -> DataFrame:
    """Requests for elevation tiles: (region_id, filename, url, tile_key, workunit, date).

    met has units of regions with list_url; a tile's box is in its own UTM zone, and so must overlap the region there. Of a tile that several units have the one
    that ended last is taken, of equal ones the first by name."""
    tiles = named_links(links.where("error is null"), [".tif", ".tiff"])
    epsg, x, y = grids.utm_tile(F.col("filename"))
    placed = tiles.select("list_url", "url", "filename", (epsg + (0 if north else 100)).alias("epsg"), x.cast("double").alias("x"), y.cast("double").alias("y")).where("epsg is not null")
    near = met.select("region_id", "list_url", "workunit", "collect_end").join(placed, "list_url").join(regions.select("region_id", "crs", *boxes.SIDES), "region_id")
    there = alignment.with_envelope(near.withColumn("zone", F.concat(F.lit("EPSG:"), F.col("epsg").cast("string"))), "crs", "zone")
    hit = there.where((F.col("x") < F.col("maxx")) & (F.col("x") + TILE > F.col("minx")) & (F.col("y") < F.col("maxy")) & (F.col("y") + TILE > F.col("miny")))
    keyed = hit.withColumn("tile_key", F.struct("epsg", "x", "y"))
    order = F.struct(F.coalesce(F.col("collect_end").cast("string"), F.lit("")).alias("date"), F.col("workunit"))
    latest = keyed.groupBy("region_id", "tile_key").agg(F.max(F.coalesce(F.col("collect_end").cast("string"), F.lit(""))).alias("date")).withColumnsRenamed({"tile_key": "k", "region_id": "r"})
    newest = keyed.join(latest, (F.col("r") == F.col("region_id")) & (F.col("k") == F.col("tile_key")) & (F.col("date") == order["date"]))
    picked = newest.groupBy("region_id", "tile_key").agg(F.min_by(F.struct("filename", "url", "workunit", "date"), F.struct("workunit", "url")).alias("t"))
    return picked.select("region_id", suffixed(F.col("t.filename"), suffix or "").alias("filename"), "t.url", "tile_key", "t.workunit", "t.date")


# Samples of headers


def sampled_links(files: DataFrame, group: str = "list_url") -> DataFrame:
    """The first, middle and last real point cloud of each list, by link."""
    return planning.first_middle_last(files.where("not placeholder"), "url", group)


def get_head(url: str, size: int = HEAD) -> bytes:
    """The first bytes of a file; no more are read even where the server sends all."""
    request = urllib.request.Request(url, headers={"Range": f"bytes=0-{size - 1}", "Accept-Encoding": "identity"})
    with urllib.request.urlopen(request, timeout=45) as answer:
        return answer.read(size)


def sample_headers(links: DataFrame, get: Callable[[str], bytes] = get_head, workers: int = 8) -> DataFrame:
    """(url, minx, miny, maxx, maxy, points, epsg, error) by the heads of point clouds; packed files have the same head."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for url in frame["url"]:
                try:
                    head = parse_header(get(url), url)
                    out.append((url, *head.bounds, head.count, head.epsg, None))
                except (OSError, ValueError) as e:
                    out.append((url, *[None] * 6, str(e)))
            yield pd.DataFrame(out, columns=["url", "minx", "miny", "maxx", "maxy", "points", "epsg", "error"]).astype({"points": "Int64", "epsg": "Int64"})

    return links.select("url").repartition(workers, "url").mapInPandas(run, "url string, minx double, miny double, maxx double, maxy double, points long, epsg long, error string")


def from_documents(spark: SparkSession, texts: dict[str, str]) -> DataFrame:
    """Lists that are at hand already, as link_lists gives them."""
    return spark.createDataFrame([(u, line, None) for u, t in texts.items() for line in t.splitlines() if line.strip()], "list_url string, link string, error string")
