"""python -m geoloom -c settings.yaml [more.yaml] [--set PATH=VALUE] [--check]"""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import SparkSession

from geoloom import components, settings


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="geoloom", description="Plans and runs acquisitions that YAML settings describe.")
    parser.add_argument("-c", "--config", nargs="+", action="extend", required=True, help="settings, merged from left to right")
    parser.add_argument("--set", dest="assignments", action="append", default=[], metavar="PATH=VALUE", help="sets one value that exists")
    parser.add_argument("--check", action="store_true", help="builds and checks everything and runs nothing")
    args = parser.parse_args(argv)
    region, pipelines = components.from_settings(settings.read(args.config, args.assignments))
    spark = SparkSession.builder.appName("geoloom").getOrCreate()
    boxes = region.regions(spark)
    if args.check:
        print(f"regions: {type(region).__name__}, {boxes.count()} of them")
        for p in pipelines:
            print(f"{p.name}: enable={p.enable} source={type(p.source).__name__} products={sorted(p.source.products)} steps={[type(s).__name__ for s in p.steps]}")
        return 0
    failed = 0
    for p in pipelines:
        if p.enable:
            _, states = p.run(spark, boxes, os.getcwd())
            counts = {r["state"]: r["count"] for r in states.groupBy("state").count().collect()}
            failed += counts.get("failed", 0) + counts.get("unavailable", 0)
            print(json.dumps({"pipeline": p.name, "regions": counts}))
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
