"""What a configured run is made of: regions, sources and steps, each a transformation of DataFrames.

A source tells the products it gives and a step those it takes and gives, so that a chain that does not fit is refused
before anything runs.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom import settings
from geoloom.functions import grids
from geoloom.operators import ledger, planning
from geoloom.sources import download, regions

Products = frozenset[str]


class RegionSource:
    def regions(self, spark: SparkSession) -> DataFrame:
        """(region_id, minx, miny, maxx, maxy, crs, ordinal)"""
        raise NotImplementedError


class Source:
    """plan gives requests (region_id, url, filename, ordinal); a file that many regions want is asked for once."""

    products: Products = frozenset()

    def plan(self, boxes: DataFrame) -> DataFrame:
        raise NotImplementedError

    def product(self) -> Callable[[str], str] | None:
        """What tells the path of the product from that of a file, where a file becomes one."""
        return None

    def materialize(self) -> Callable[[str, str | None], str] | None:
        """What turns a file that came, with the request's detail, into its product, in the task that fetched it."""
        return None


class Step:
    """process takes and gives assets (region_id, filename, path, status, error), beside the regions."""

    def flow(self, products: Products) -> Products:
        return products

    def expected(self, region_id: str) -> str | None:
        """The file that the step will give for a region, where that is known beforehand."""
        return None

    def process(self, assets: DataFrame, boxes: DataFrame) -> DataFrame:
        raise NotImplementedError


class BoxRegions(RegionSource):
    def __init__(self, source: list | dict, crs: str = "EPSG:4326", region: str = "region_0"):
        self.source, self.crs, self.region = source, crs, region

    def regions(self, spark: SparkSession) -> DataFrame:
        return regions.named_boxes(spark, self.source, self.crs, self.region)


class XyzTiles(Source):
    """Web map tiles that regions in degrees touch; url_template has {z}, {x} and {y}."""

    products = frozenset({"image"})

    def __init__(self, url_template: str, zoom: int, prefix: str = "tile", extension: str = ".jpg"):
        if not 0 <= zoom <= 30 or any(p not in url_template for p in ("{x}", "{y}", "{z}")):
            raise ValueError("a template needs {x}, {y} and {z}, and a zoom from 0 to 30")
        self.url_template, self.zoom, self.prefix, self.extension = url_template, zoom, prefix, extension

    def plan(self, boxes: DataFrame) -> DataFrame:
        tiles = grids.xyz_cover(boxes, self.zoom)
        url = F.lit(self.url_template)
        for name, value in (("{z}", F.lit(self.zoom)), ("{x}", F.col("tile_x")), ("{y}", F.col("tile_y"))):
            url = F.replace(url, F.lit(name), value.cast("string"))
        named = F.format_string(f"{self.prefix}_z%d_x%d_y%d{self.extension}", F.lit(self.zoom), F.col("tile_x"), F.col("tile_y"))
        return tiles.select("region_id", url.alias("url"), named.alias("filename"), F.col("ordinal").cast("long").alias("ordinal"))


class PassThrough(Step):
    """Changes nothing; its message goes to standard output when the chain is laid out."""

    def __init__(self, message: str = ""):
        self.message = message

    def process(self, assets: DataFrame, boxes: DataFrame) -> DataFrame:
        if self.message:
            print(self.message)
        return assets


class OnlyProducts(Step):
    """Refuses a source that does not give one of the products."""

    def __init__(self, products: list[str]):
        self.products = frozenset(products)

    def flow(self, products: Products) -> Products:
        if not products & self.products:
            raise ValueError(f"the chain gives {sorted(products)}, a step takes {sorted(self.products)}")
        return products & self.products

    def process(self, assets: DataFrame, boxes: DataFrame) -> DataFrame:
        return assets


@dataclass
class Pipeline:
    name: str
    source: Source
    steps: list[Step] = field(default_factory=list)
    enable: bool = True
    output_dir: str | None = None
    max_workers: int = 4
    max_retries: int = 3
    retry_delay: float = 2.0
    overwrite: bool = False

    def __post_init__(self) -> None:
        if self.max_workers < 1 or self.max_retries < 0 or self.retry_delay < 0:
            raise ValueError(f"pipeline {self.name} has numbers out of range")
        products = self.source.products
        for step in self.steps:
            products = step.flow(products)

    def run(self, spark: SparkSession, boxes: DataFrame, workspace: str = ".") -> tuple[DataFrame, DataFrame]:
        """(assets, regions): a row per region and file, and per region whether all its files came and were processed.

        The files' states are held, as both tables read them and a download must not run twice.
        """
        every, boxes = boxes, self.pending(spark, boxes, workspace)
        requests = self.source.plan(boxes)
        files = requests.groupBy("filename").agg(F.min_by("url", "ordinal").alias("url"))
        folder = settings.output_folder(self.output_dir, [], workspace)
        extra = [c for c in ("form", "detail") if c in requests.columns]
        files = files.join(requests.groupBy("filename").agg(*(F.min_by(c, "ordinal").alias(c) for c in extra)), "filename") if extra else files
        got = download.download(files, folder, self.max_retries, self.retry_delay, self.overwrite, self.max_workers, self.source.materialize(), self.source.product()).persist()
        wanted = planning.targets_in_order(requests, "filename", "region_id", "ordinal")
        owned = wanted.select("filename", F.col("targets")[0].alias("region_id"), F.col("targets").alias("target_region_ids"))
        assets = ledger.fan_out(owned.join(got.select("filename", "status"), "filename")).join(got.select("filename", "path", "error"), "filename")
        for step in self.steps:
            # a region of which a file or an earlier step failed goes no further
            stopped = assets.where("status = 'failed'").select("region_id").distinct()
            going = boxes.join(stopped, "region_id", "left_anti")
            done = step.process(assets.join(stopped, "region_id", "left_anti"), going)
            assets = assets.join(stopped, "region_id", "left_semi").select(*done.columns).unionByName(done)
        ready = assets.groupBy("region_id").agg(F.count_if(F.col("status") == "failed").alias("failed"), F.count(F.lit(1)).alias("files"))
        there = boxes.select("region_id", F.lit(True).alias("pending"))
        states = every.select("region_id").join(there, "region_id", "left").join(ready, "region_id", "left")
        state = F.when(F.col("pending").isNull(), "existing").when(F.col("files").isNull(), "unavailable").when(F.col("failed") > 0, "failed").otherwise("complete")
        return assets, states.select("region_id", F.coalesce("files", F.lit(0)).alias("files"), state.alias("state"))

    def pending(self, spark: SparkSession, boxes: DataFrame, workspace: str) -> DataFrame:
        """Regions that lack the last file of some step; those that have all are not planned again."""
        steps = [s for s in self.steps if s.expected("x") is not None]
        if not steps or self.overwrite:
            return boxes
        last = steps[-1]

        def lacking(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                yield frame[[not os.path.exists(last.expected(r)) for r in frame["region_id"]]]

        return boxes.mapInPandas(lacking, boxes.schema)


def from_settings(tree: settings.Tree) -> tuple[RegionSource, list[Pipeline]]:
    if unknown := sorted(set(tree) - {"region", "pipelines", "reporting"}):
        raise ValueError(f"unknown settings {unknown}")
    pipelines = []
    for item in tree["pipelines"]:
        own = dict(item)
        source, steps = settings.build(own.pop("source"), Source), [settings.build(s, Step) for s in own.pop("postprocess", None) or []]
        pipelines.append(Pipeline(own.pop("name", ""), source, steps, own.pop("enable", True), **(own.pop("acquire", None) or {})))
        if own:
            raise ValueError(f"unknown pipeline settings {sorted(own)}")
    return settings.build(tree["region"], RegionSource), pipelines
