"""Sources and steps that settings name: each plans requests as a DataFrame, and tells how a file that came becomes its product.

Addresses, folders of caches and what asks a portal are settings with defaults, so that tests and mirrors can put others in.
"""

from __future__ import annotations

import functools
import json
import os
import urllib.parse
import urllib.request
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.components import Products, RegionSource, Source, Step
from geoloom.functions import grids
from geoloom.functions.text import suffixed
from geoloom.operators import alignment, boxes, naming, planning
from geoloom.sources import archives, catalogs, geopackage, listing, portals, rasters, regions, units

# Where the public catalogues are.
WORK_UNITS = "https://prd-tnm.s3.amazonaws.com/StagedProducts/Elevation/metadata/WESM.gpkg"
ELEVATION = "https://rockyweb.usgs.gov/vdelivery/Datasets/Staged/Elevation/1m/Projects"
PUBLIC_CELLS = "https://copernicus-dem-{arc}m.s3.amazonaws.com"
FILES, FOOTPRINTS, DESCRIPTIONS = (f"https://centrodedescargas.cnig.es/CentroDescargas/{p}" for p in ("archivosSerie", "localizarCoordsSec", "descargaDir"))
SHEETS = "https://pe3d.pe.gov.br/"
RELEASES = "https://s3-us-west-2.amazonaws.com/config.maptiles.arcgis.com/waybackconfig.json"
DATED = "https://wayback.maptiles.arcgis.com/arcgis/rest/services/World_Imagery/WMTS/1.0.0/default028mm/MapServer/tile/{version}/{z}/{y}/{x}"
COLUMNS = ("workunit", "project", "lpc_link", "sourcedem_link", "collect_end", "horiz_crs")


def post_form(url: str, form: dict[str, str]) -> str:
    request = urllib.request.Request(url, urllib.parse.urlencode(form).encode(), {"X-Requested-With": "XMLHttpRequest"})
    with urllib.request.urlopen(request, timeout=60) as answer:
        return answer.read().decode("utf-8", "replace")


# Regions


class RasterRegions(RegionSource):
    """A raster, or a folder of them; those that end in a suffix of an output, and those whose outputs are all there, are left out."""

    def __init__(self, source: str, skip_suffixes: list[str] | None = None, skip_done: list[str] | None = None):
        self.source, self.skip_suffixes, self.skip_done = source, skip_suffixes or [], skip_done or []

    def regions(self, spark: SparkSession) -> DataFrame:
        files = listing.folder(spark, self.source)
        chosen = listing.target_rasters(files, [*self.skip_suffixes, *self.skip_done])
        if self.skip_done:
            chosen = chosen.join(listing.without_outputs(files, self.skip_done).select("stem"), "stem", "left_semi")
        found = rasters.raster_regions(chosen)
        return found.withColumnRenamed("path", "target_path").withColumn("ordinal", F.lit(0))


class PointRegions(RegionSource):
    def __init__(self, source: str, id_field: str | None = None, query_size_m: float = 500.0, include_values: dict[str, list[str]] | None = None, crs: str = "EPSG:4326"):
        self.source, self.id_field, self.query_size_m, self.include_values, self.crs = source, id_field, query_size_m, include_values, crs

    def regions(self, spark: SparkSession) -> DataFrame:
        return regions.geojson_points(spark, self.source, self.id_field, self.query_size_m, self.include_values, self.crs)


class PolygonRegions(RegionSource):
    def __init__(self, source: str, id_field: str | None = None, crs: str = "EPSG:4326"):
        self.source, self.id_field, self.crs = source, id_field, crs

    def regions(self, spark: SparkSession) -> DataFrame:
        return regions.geojson_polygons(spark, self.source, self.id_field, self.crs)


def in_degrees(boxes_: DataFrame) -> DataFrame:
    return alignment.with_envelope(boxes_.withColumn("_to", F.lit("EPSG:4326")), "crs", "_to").drop("_to")


# Sources


class UnitSource(Source):
    """What sources of work units share: the catalogue in a GeoPackage, and the cache of lists of links."""

    def __init__(self, cache_dir: str = "./cache/wesm", link_cache_dir: str = "./cache/link_lists", link_cache_days: float = 10.0, catalogue: str = WORK_UNITS, least_bytes: int = units.LEAST_CATALOGUE, get: units.Get = units.get_text):
        if link_cache_days < 0:
            raise ValueError("a cache cannot be kept for less than no time")
        self.cache_dir, self.link_cache_dir, self.link_cache_days, self.catalogue, self.least_bytes, self.get = cache_dir, link_cache_dir, link_cache_days, catalogue, least_bytes, get

    def work_units(self, spark: SparkSession, degrees: DataFrame) -> DataFrame:
        """Units in the box around all regions, read through the catalogue's own index."""
        path = units.ensure_catalogue(self.catalogue, os.path.join(self.cache_dir, "WESM.gpkg"), self.least_bytes)
        spark.dataSource.register(geopackage.GeoPackageSource)
        around = regions.batch_envelopes(degrees.withColumn("_g", F.lit(1)), "_g").first()
        read = spark.read.format("geopackage").option("path", path).option("columns", ",".join(COLUMNS))
        if around is not None:
            read = read.option("bbox", ",".join(str(around[s]) for s in boxes.SIDES))
        return read.load().select(*COLUMNS, *boxes.SIDES).where("minx is not null")

    def links(self, listed: DataFrame) -> DataFrame:
        return units.link_lists(listed, "list_url", self.link_cache_dir, self.link_cache_days, self.get)


class UnitClouds(UnitSource):
    """Point clouds of work units, newest first, by a catalogue of naming rules; as surfaces or terrain where a product asks for it."""

    def __init__(self, rules: str, output_products: list[str] | None = None, resolution: float = 1.0, keep_download: bool = False, mode: str = "download", audit_report: str | None = None, **shared):
        super().__init__(**shared)
        self.rules_path, self.resolution, self.keep_download, self.mode, self.audit_report = rules, resolution, keep_download, mode, audit_report
        self.products = frozenset(output_products or ["laz"])
        if unknown := self.products - {"laz", "dsm", "dtm"}:
            raise ValueError(f"no products {sorted(unknown)}")
        if len(self.products - {"laz"}) > 1:
            raise ValueError("one raster product a pipeline; name another pipeline for the other")
        if mode not in ("download", "audit") or resolution <= 0:
            raise ValueError("mode is download or audit, and a resolution positive")

    def _raster(self) -> str | None:
        return next(iter(self.products - {"laz"}), None)

    def product(self) -> Callable[[str], str] | None:
        return functools.partial(rasters.surface_path, product=self._raster()) if self._raster() else None

    def materialize(self) -> Callable[[str], str] | None:
        if self._raster() is None:
            return None
        return functools.partial(rasters.surface, product=self._raster(), resolution=self.resolution, keep=self.keep_download or "laz" in self.products)

    def planned(self, boxes_: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(files with their boxes, work units with their regions)."""
        degrees = in_degrees(boxes_.select("region_id", *boxes.SIDES, "crs"))
        found = self.work_units(boxes_.sparkSession, degrees)
        ordered = units.ordered_units(units.units_of_regions(degrees, found, 1.0))
        listed = ordered.select(F.when(F.length("lpc_link") > 0, F.concat("lpc_link", F.lit("/" + units.LIST))).alias("list_url"))
        return units.planned_clouds(ordered, self.links(listed), naming.read_rules(self.rules_path)), ordered

    def audit(self, boxes_: DataFrame) -> DataFrame:
        return units.unit_audit(*self.planned(boxes_))

    def plan(self, boxes_: DataFrame) -> DataFrame:
        if self.mode == "audit":
            found = self.audit(boxes_)
            if self.audit_report:
                units.write_report(found, self.audit_report)
            return boxes_.sparkSession.sql("SELECT '' AS region_id, '' AS url, '' AS filename, 0L AS ordinal, '' AS detail WHERE false")
        files, ordered = self.planned(boxes_)
        selected = units.select_clouds(files, boxes_, ordered, 1.0)
        wanted = units.requests(selected)
        return wanted.select(F.explode("target_region_ids").alias("region_id"), "url", "filename", "ordinal", F.col("tile_crs").alias("detail"))


class UnitElevation(UnitSource):
    """Elevation tiles of ten kilometres, the newest of each."""

    products = frozenset({"dem"})

    def __init__(self, filename_suffix: str | None = None, hemisphere: str = "north", projects: str = ELEVATION, **shared):
        super().__init__(**shared)
        if hemisphere not in ("north", "south"):
            raise ValueError("a hemisphere is north or south")
        self.suffix, self.north, self.projects = filename_suffix, hemisphere == "north", projects

    def plan(self, boxes_: DataFrame) -> DataFrame:
        degrees = in_degrees(boxes_.select("region_id", *boxes.SIDES, "crs"))
        met = units.units_of_regions(degrees, self.work_units(boxes_.sparkSession, degrees), 1.0)
        listed = met.where("project is not null").withColumn("list_url", F.concat(F.lit(self.projects + "/"), "project", F.lit("/" + units.LIST)))
        found = units.elevation_tiles(self.links(listed.select("list_url")), boxes_, listed, self.suffix, self.north)
        return found.select("region_id", "url", "filename", F.lit(0).cast("long").alias("ordinal"))


class CatalogueTiles(Source):
    """Tiles of a static catalogue whose footprint shares area with a region; read again when its copy is old, from the copy where that fails."""

    products = frozenset({"dem"})

    def __init__(self, collection_url: str, cache_path: str, cache_days: float = 10.0, filename_suffix: str | None = None, get: units.Get = units.get_text):
        self.collection_url, self.cache_path, self.cache_days, self.suffix, self.get = collection_url, cache_path, cache_days, filename_suffix, get

    def _documents(self, spark: SparkSession, found: DataFrame, url: str) -> DataFrame:
        folder, days, get = self.cache_path, self.cache_days, self.get

        def run(frames):
            import pandas as pd

            for frame in frames:
                yield pd.DataFrame([(u, units.cached_text(u, folder, days, get)) for u in frame[url]], columns=[url, "document"])

        return found.select(url).repartition(8).mapInPandas(run, f"{url} string, document string")

    def plan(self, boxes_: DataFrame) -> DataFrame:
        spark = boxes_.sparkSession
        own = self._documents(spark, spark.sql(f"SELECT '{self.collection_url}' AS url"), "url")
        items = self._documents(spark, catalogs.stac_item_links(own), "item_url")
        tiles = catalogs.stac_items(items)
        degrees = in_degrees(boxes_.select("region_id", *boxes.SIDES, "crs"))
        met = boxes.box_join(boxes.prefixed(degrees, "l_"), boxes.prefixed(tiles.select("tile_id", "url", *boxes.SIDES), "r_"), 1.0)
        name = F.concat("r_tile_id", F.lit(".tif"))
        return met.select(F.col("l_region_id").alias("region_id"), F.col("r_url").alias("url"), suffixed(name, self.suffix or "").alias("filename"), F.lit(0).cast("long").alias("ordinal"))


class PortalFiles(Source):
    """Files of a paged portal, of each sheet the one in the zone of a region's centre; more than the portal gives away are refused."""

    def __init__(self, product: str = "mdt50cm", footprint_cache_path: str = "./cache/cnig/footprints.json", most: int = portals.QUOTA, post: portals.Post = post_form, urls: tuple[str, str, str] = (FILES, FOOTPRINTS, DESCRIPTIONS)):
        self.spec = portals.product("cnig", product)
        self.cache_path, self.most, self.post, self.urls = footprint_cache_path, most, post, urls
        self.products = frozenset({self.spec["product"]})

    def plan(self, boxes_: DataFrame) -> DataFrame:
        spark = boxes_.sparkSession
        shaped = boxes_ if "polygons" in boxes_.columns else boxes_.withColumn("polygons", F.lit(None).cast("array<array<array<array<double>>>>"))
        degrees = regions.reprojected(shaped, "EPSG:4326")
        queries = degrees.select(F.col("region_id").alias("query_id"), F.concat(F.lit('{"type":"MultiPolygon","coordinates":'), F.to_json("polygons"), F.lit("}")).alias("geometry"))
        files = portals.paged_files(queries, self.post, self.urls[0], self.spec)
        cached = portals.read_cache(self.cache_path)
        known = spark.createDataFrame([(s, json.dumps(g)) for s, g in cached.items()], "sequential string, geometry string")
        found = portals.footprints(files, known, self.post, self.urls[1])
        fresh = {r["sequential"]: json.loads(r["geometry"]) for r in found.join(known, "sequential", "left_anti").collect()}  # as many as one question may select
        if fresh:
            portals.write_cache(self.cache_path, cached | fresh)
        whole = F.from_json("geometry", "struct<type:string,coordinates:string>")
        one, many = (F.from_json(whole["coordinates"], regions.KINDS[k]) for k in ("Polygon", "MultiPolygon"))
        every = spark.createDataFrame([(s, json.dumps(g)) for s, g in (cached | fresh).items()], "sequential string, geometry string")
        shapes = every.select("sequential", F.when(whole["type"] == "Polygon", F.array(one)).otherwise(many).alias("polygons"))
        rings = lambda c: F.transform(F.flatten(c), lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
        coordinate = lambda k: F.transform(F.flatten(F.flatten("polygons")), lambda p: p[k])
        sided = lambda rows, prefix: rows.select(*rows.columns, rings("polygons").alias("rings"), *(pick(coordinate(k)).alias(n) for n, pick, k in zip(boxes.SIDES, (F.array_min, F.array_min, F.array_max, F.array_max), (0, 1, 0, 1), strict=True))).drop("polygons").transform(lambda f: boxes.prefixed(f, prefix))
        met = boxes.footprint_join(sided(degrees, "l_"), sided(shapes.join(files.select("sequential", "filename").distinct(), "sequential"), "r_"), 1.0)
        chosen = portals.choose_zones(met.select(F.col("l_region_id").alias("region_id"), ((F.col("l_minx") + F.col("l_maxx")) / 2).alias("center_x"), F.col("r_filename").alias("filename")))
        numbers = files.groupBy("filename").agg(F.min("sequential").alias("sequential"))
        allowed = portals.within_quota(chosen, self.most)
        return allowed.join(numbers, "filename").select("region_id", F.lit(self.urls[2]).alias("url"), "filename", F.lit(0).cast("long").alias("ordinal"), F.create_map(F.lit("secDescDirLA"), "sequential").alias("form"))


class SheetArchives(Source):
    """Archives of 1:5000 sheets that share enough area with a region. pages(sheets) asks the portal, after signing in."""

    def __init__(self, quadrangles: str, pages: Callable[[list[str]], list[str]], product: str = "dtm_raster", min_intersection_fraction: float = 0.0, batch_size: int = 100, base: str = SHEETS):
        if not 0 <= min_intersection_fraction <= 1 or batch_size < 1:
            raise ValueError("a share lies between 0 and 1, and a batch has one sheet at least")
        self.spec = portals.product("pe3d", product)
        self.quadrangles, self.pages, self.fraction, self.batch_size, self.base = quadrangles, pages, min_intersection_fraction, batch_size, base
        self.products = frozenset({self.spec["product"]})

    def product(self) -> Callable[[str], str]:
        return functools.partial(_sheet_path, primary=self.spec["primary"])

    def materialize(self) -> Callable[[str], str]:
        return functools.partial(_unpack_sheet, primary=self.spec["primary"], sidecars=self.spec["sidecars"])

    def sheets(self, boxes_: DataFrame) -> DataFrame:
        degrees = in_degrees(boxes_.select("region_id", *boxes.SIDES, "crs"))
        covered = grids.sheet_cover(degrees, self.fraction)
        centre = lambda v, step, sign: sign * (F.col(v) + 0.5) * step
        return covered.select("region_id", grids.sheet_code(centre("sheet_column", grids.SHEET_LON, 1) - 180.0, centre("sheet_row", grids.SHEET_LAT, -1)).alias("sheet"))

    def resolved(self, boxes_: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(sheets of regions, links of sheets, what became of each sheet)."""
        spark = boxes_.sparkSession
        wanted = self.sheets(boxes_).distinct()
        known = catalogs.quadrangles(spark.read.text(self.quadrangles, wholetext=True).withColumnRenamed("value", "document"))
        asked = portals.link_batches(wanted.select("sheet").distinct().join(known.select("sheet", "portal_id"), "sheet"), self.batch_size)
        documents = [page for r in asked.groupBy("batch").agg(F.array_sort(F.collect_list("portal_id")).alias("ids")).orderBy("batch").toLocalIterator() for page in self.pages(r["ids"])]
        answered = spark.createDataFrame([(d,) for d in documents], "document string")
        found = portals.sheet_downloads(answered, asked.select("sheet"), self.base, self.spec)
        none = wanted.select("sheet").where("false")
        return wanted, found, portals.resolve_sheets(wanted, none, known, found)

    def plan(self, boxes_: DataFrame) -> DataFrame:
        wanted, found, _ = self.resolved(boxes_)
        return wanted.join(found, "sheet", "left").select("region_id", "url", F.coalesce("filename", F.concat(F.lit(self.spec["prefix"]), "sheet", F.lit(".zip"))).alias("filename"), F.lit(0).cast("long").alias("ordinal"))


def _sheet_path(path: str, primary: str) -> str:
    return os.path.splitext(path)[0] + primary


def _unpack_sheet(path: str, detail: str | None = None, primary: str = ".tif", sidecars: tuple[str, ...] = ()) -> str:
    stem = os.path.splitext(os.path.basename(path))[0]
    out = archives.unpack(path, os.path.dirname(path), lambda names: archives.sheet_members(names, stem, primary, sidecars))
    os.remove(path)
    return out


class DatedTiles(Source):
    """Web map tiles of the release nearest to a date."""

    products = frozenset({"image"})

    def __init__(self, date: str, zoom: int, url_template: str = DATED, releases: str = RELEASES, get: units.Get = units.get_text, prefix: str = "wayback"):
        self.date, self.zoom, self.url_template, self.releases, self.get, self.prefix = date, zoom, url_template, releases, get, prefix

    def plan(self, boxes_: DataFrame) -> DataFrame:
        from geoloom.components import XyzTiles

        spark = boxes_.sparkSession
        known = catalogs.releases(spark.createDataFrame([(self.get(self.releases),)], "document string"))
        asked = spark.createDataFrame([(0, self.date)], "k int, wanted string").withColumn("wanted", F.to_date("wanted"))
        nearest = planning.nearest_release(asked, known, "k", "date").join(known, F.col("release") == F.col("date")).agg(F.min("version").alias("version"), F.min("release").alias("release")).first()
        if nearest["version"] is None:
            raise ValueError("there is no release")
        tag = nearest["release"].strftime("%y%m%d")
        return XyzTiles(self.url_template.replace("{version}", nearest["version"]), self.zoom, f"{self.prefix}_{tag}").plan(boxes_)


class DegreeTiles(Source):
    """Public elevation cells of one degree; a cell that is all sea has no file, which shows as a failure."""

    products = frozenset({"dem"})

    def __init__(self, resolution: str = "30", filename_suffix: str | None = None, base: str = PUBLIC_CELLS):
        if resolution not in ("30", "90"):
            raise ValueError("the resolution is 30 or 90")
        self.arc, self.resolution, self.suffix, self.base = {"30": "10", "90": "30"}[resolution], resolution, filename_suffix, base.replace("{arc}", resolution)

    def plan(self, boxes_: DataFrame) -> DataFrame:
        cells = grids.degree_cells(in_degrees(boxes_.select("region_id", *boxes.SIDES, "crs")), self.arc)
        name = F.replace("tile", F.lit("_DSM_"), F.lit("_DSM_COG_"))
        return cells.select("region_id", F.concat(F.lit(self.base + "/"), name, F.lit("/"), name, F.lit(".tif")).alias("url"), suffixed(F.concat("tile", F.lit(".tif")), self.suffix or "").alias("filename"), F.lit(0).cast("long").alias("ordinal"))


class SearchedTiles(Source):
    """Elevation cells of a portal with accounts: a search for each cell, of which the latest delivery is taken. search(filter) asks with the session's token."""

    products = frozenset({"dem"})

    def __init__(self, search: Callable[[str], str], download_url: str, resolution: str = "30", dem_format: str = "DGED"):
        portals.product("copdem", f"{dem_format}-{resolution}")
        self.search, self.download_url, self.resolution, self.form = search, download_url, resolution, dem_format

    def product(self) -> Callable[[str], str]:
        return functools.partial(_sheet_path, primary="_copdem.tif")

    def materialize(self) -> Callable[[str], str]:
        return _unpack_cell

    def plan(self, boxes_: DataFrame) -> DataFrame:
        cells = grids.degree_cells(in_degrees(boxes_.select("region_id", *boxes.SIDES, "crs")), {"30": "10", "90": "30"}[self.resolution])
        asked = cells.select("tile").distinct().withColumn("filter", portals.search_filter(F.col("tile"), self.form, self.resolution))
        answers = [(r["tile"], self.search(r["filter"])) for r in asked.toLocalIterator()]  # one after the other, as the account allows
        found = catalogs.latest_products(boxes_.sparkSession.createDataFrame(answers, "tile string, document string"), "tile")
        url = F.replace(F.lit(self.download_url), F.lit("{product_id}"), F.col("product_id"))
        return cells.join(found, "tile", "left").select("region_id", F.when(F.col("product_id").isNotNull(), url).alias("url"), F.concat("tile", F.lit(".zip")).alias("filename"), F.lit(0).cast("long").alias("ordinal"))


def _unpack_cell(path: str, detail: str | None = None) -> str:
    stem = os.path.splitext(os.path.basename(path))[0]
    out = archives.unpack(path, os.path.dirname(path), lambda names: [(archives.elevation_member(names, stem), f"{stem}_copdem.tif")])
    os.remove(path)
    return out


# Steps


class RasterStep(Step):
    """What steps over rasters share: which products they take, and where their files go."""

    def __init__(self, output_suffix: str, input_products: list[str] | None = None, output_dir: str = ".", skip_existing: bool = True):
        self.suffix, self.input_products, self.output_dir, self.skip_existing = output_suffix, frozenset(input_products or ()), output_dir, skip_existing

    def flow(self, products: Products) -> Products:
        if self.input_products and not products & self.input_products:
            raise ValueError(f"the chain gives {sorted(products)}, a step takes {sorted(self.input_products)}")
        return products & self.input_products if self.input_products else products

    def expected(self, region_id: str) -> str:
        return os.path.join(self.output_dir, f"{region_id}_{self.suffix}.tif")

    def usable(self, assets: DataFrame) -> DataFrame:
        return assets.where(F.col("status").isin("success", "skipped", "reused") & F.col("path").isNotNull())

    def outcome(self, assets: DataFrame, written: DataFrame) -> DataFrame:
        """A row for each region: its raster, or why there is none; what failed before stays."""
        failed = assets.where("status = 'failed'").select("region_id", "filename", "path", "status", "error")
        made = written.select(F.col("raster_id").alias("region_id"), F.concat("raster_id", F.lit(f"_{self.suffix}.tif")).alias("filename"), "path", F.when(F.col("error").isNull(), "success").otherwise("failed").alias("status"), "error")
        return failed.unionByName(made)


class AlignToTarget(RasterStep):
    """A region's rasters on the grid of its target raster: mosaic, reprojection and resampling; or, without resampling, the source's own cells around it."""

    def __init__(self, output_suffix: str, input_products: list[str] | None = None, output_dir: str = ".", resample: bool = True, target_scale: int = 1, resampling: str = "bilinear", merge_method: str = "first", skip_existing: bool = True):
        super().__init__(output_suffix, input_products, output_dir, skip_existing)
        if target_scale < 1 or merge_method not in ("first", "last"):
            raise ValueError("a scale is 1 at least, and the first or the last source wins")
        self.resample, self.scale, self.method, self.merge = resample, target_scale, resampling, merge_method

    def process(self, assets: DataFrame, boxes_: DataFrame) -> DataFrame:
        ready = self.usable(assets)
        files = ready.select("path").distinct().withColumn("raster_id", F.col("path"))
        heads = rasters.headers(files).where("error is null").drop("error")
        sources = ready.select("region_id", "path").distinct().join(heads, "path")
        cells = rasters.read_cells(files)
        tags = F.create_map(F.lit("TARGET_SCALE"), F.lit(str(self.scale)), F.lit("RESAMPLING"), F.lit(self.method if self.resample else "none"), F.lit("VERTICAL_CONVERSION"), F.lit("false"))
        if self.resample:
            target = boxes_.where("target_path is not null").select("region_id", F.col("pixel_x").alias("a"), F.lit(0.0).alias("b"), F.col("minx").alias("c"), F.lit(0.0).alias("d"), (-F.col("pixel_y")).alias("e"), F.col("maxy").alias("f"), "width", "height", "crs")
            grid = alignment.target_grid(target, self.scale)
            pairs = alignment.pair_grids(grid, sources, 1000.0)
            out = alignment.align(pairs, cells, self.method, self.merge).withColumnRenamed("region_id", "raster_id")
            places = grid.join(ready.select("region_id").distinct(), "region_id", "left_semi").select(F.col("region_id").alias("raster_id"), "width", "height", F.col("c").alias("left"), F.col("f").alias("top"), F.col("a").alias("pixel"), F.expr("try_cast(substring_index(crs, ':', -1) as int)").alias("epsg"), tags.alias("tags"))
        else:
            first = sources.groupBy("region_id").agg(F.min_by(F.struct("raster_id", *alignment.GRID), "path").alias("s")).select("region_id", F.col("s.raster_id").alias("raster_id"), *(F.col(f"s.{k}").alias(f"s_{k}") for k in alignment.GRID))
            boxed = boxes_.select("region_id", *boxes.SIDES, "crs").join(first, "region_id")
            framed = alignment.native_grid(alignment.with_envelope(boxed, "crs", "s_crs"))
            like = framed.select("region_id", F.col("o_c").alias("c"), F.col("o_f").alias("f"), F.col("s_a").alias("a"), F.col("s_b").alias("b"), F.col("s_d").alias("d"), F.col("s_e").alias("e"), F.col("out_width").alias("width"), F.col("out_height").alias("height"), F.col("s_crs").alias("crs"))
            out = alignment.align(alignment.pair_grids(like, sources, 1000.0), cells, "nearest", self.merge).withColumnRenamed("region_id", "raster_id")
            places = like.select(F.col("region_id").alias("raster_id"), F.col("width").cast("int"), F.col("height").cast("int"), F.col("c").alias("left"), F.col("f").alias("top"), F.col("a").alias("pixel"), F.expr("try_cast(substring_index(crs, ':', -1) as int)").alias("epsg"), tags.alias("tags"))
        return self.outcome(assets, rasters.write_cells(out, places, self.output_dir, f"_{self.suffix}", masked=True))


class NativeWindow(RasterStep):
    """A window of native cells about a region's point: cells are copied, and only seams of sources that nearly fit are filled by resampling."""

    def __init__(self, output_suffix: str, size_m: float, input_products: list[str] | None = None, output_dir: str = ".", min_valid_fraction: float = 1.0, max_grid_snap_pixels: float = 0.0, fallback_resampling: str | None = None, max_resolution_mismatch_fraction: float = 0.001, max_resampled_fraction: float = 0.25, skip_existing: bool = True):
        super().__init__(output_suffix, input_products, output_dir, skip_existing)
        if size_m <= 0 or not 0 < min_valid_fraction <= 1 or fallback_resampling not in (None, "bilinear"):
            raise ValueError("a size is positive, a share between 0 and 1, and seams are filled bilinearly or not")
        self.size_m, self.least, self.snap, self.fill, self.mismatch, self.cap = size_m, min_valid_fraction, max_grid_snap_pixels, fallback_resampling, max_resolution_mismatch_fraction, max_resampled_fraction

    def process(self, assets: DataFrame, boxes_: DataFrame) -> DataFrame:
        ready = self.usable(assets)
        files = ready.select("path").distinct().withColumn("raster_id", F.col("path"))
        heads = rasters.headers(files).where("error is null").drop("error")
        own = ready.select("region_id", "path").distinct().join(heads, "path")
        cells = rasters.read_cells(files)
        systems = own.groupBy("region_id").agg(F.min_by("crs", "path").alias("to"))
        points = alignment.with_place(boxes_.select("region_id", "x", "y", "crs").join(systems, "region_id"), "crs", "to").select(F.col("region_id").alias("point_id"), "region_id", "x", "y")
        windows = alignment.point_windows(alignment.anchors(points, own.drop("bands"), 1000.0), self.size_m)
        fitted = alignment.fit_of_sources(windows, own, self.snap, self.mismatch if self.fill else None)
        native = alignment.native_mosaic(fitted, cells)
        filled = alignment.seam_fill(fitted, native, cells, self.least, self.cap) if self.fill else native.withColumn("resampled", F.lit(False))
        report = alignment.window_report(fitted, filled, self.least)
        placed = windows.select("point_id", "width", "height", "o_c", "o_f", "s_a", "s_crs", "x", "y").join(report, "point_id")
        tags = F.create_map(*(v for k, c in (("POINT_X", "x"), ("POINT_Y", "y"), ("VALID_FRACTION", "valid_fraction"), ("RESAMPLED_PIXELS", "n_resampled"), ("RESAMPLED_FRACTION", "resampled_fraction"), ("SOURCE_COUNT", "sources"), ("RESAMPLING", "resampling")) for v in (F.lit(k), F.col(c).cast("string"))), F.lit("REQUESTED_SIZE_M"), F.lit(str(self.size_m)), F.lit("RESAMPLED_SOURCES"), F.array_join("resampled_sources", ";"))
        places = placed.where("enough").select(F.col("point_id").alias("raster_id"), F.col("width").cast("int"), F.col("height").cast("int"), F.col("o_c").alias("left"), F.col("o_f").alias("top"), F.col("s_a").alias("pixel"), F.expr("try_cast(substring_index(s_crs, ':', -1) as int)").alias("epsg"), tags.alias("tags"))
        written = rasters.write_cells(filled.withColumnRenamed("point_id", "raster_id"), places, self.output_dir, f"_{self.suffix}", masked=True)
        lacking = placed.where("not enough").select(F.col("point_id").alias("raster_id"), F.lit(None).cast("string").alias("path"), F.lit(0).cast("long").alias("valid"), F.format_string("only %.6f of the window is valid", "valid_fraction").alias("error"))
        none = boxes_.select(F.col("region_id").alias("raster_id")).join(windows.select(F.col("point_id").alias("raster_id")), "raster_id", "left_anti").select("raster_id", F.lit(None).cast("string").alias("path"), F.lit(0).cast("long").alias("valid"), F.lit("no source contains the point").alias("error"))
        return self.outcome(assets, written.unionByName(lacking).unionByName(none))


def described() -> dict[str, list[str]]:
    """The classes that settings can name, by kind."""
    import geoloom.components as base

    here = [v for m in (base, __import__(__name__, fromlist=["x"])) for v in vars(m).values() if isinstance(v, type)]
    return {kind.__name__: sorted({f"{c.__module__}.{c.__name__}" for c in here if issubclass(c, kind) and c is not kind}) for kind in (RegionSource, Source, Step)}
