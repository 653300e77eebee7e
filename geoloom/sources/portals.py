"""Download portals: tables of files on web pages, links inside frames, sessions with tokens, and the products each portal has.

Pages come as frames with one document a row, as a download gives them; what talks to a portal is a function that the caller
may replace, and runs where it is called.
"""

from __future__ import annotations

import html
import json
import os
import re
import time
import urllib.error
import urllib.parse
import urllib.request
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.functions.text import basename, trusted, url_path
from geoloom.operators.planning import batches

Post = Callable[[str, dict[str, str]], str]

# Products of the portals and how their files are named.
PRODUCTS: dict[tuple[str, str], dict[str, Any]] = {
    ("cnig", "mdt50cm"): {"group": "MOMDT", "series": "MDT01", "page": "modelo-digital-terreno-mdt50cm", "prefix": "MDT50CM-", "resolution": 0.5, "product": "dtm", "ready": True},
    ("pe3d", "orthoimage"): {"code": "1", "product": "imagery", "ready": False},
    ("pe3d", "dsm_raster"): {"code": "2", "product": "dsm", "ready": False},
    ("pe3d", "dsm_xyzi"): {"code": "3", "product": "dsm", "ready": False},
    ("pe3d", "dtm_raster"): {"code": "4", "product": "dtm", "prefix": "MDT-", "scale": "1_5000", "folder": "4_MDT_RASTER", "primary": ".tif", "sidecars": (".tfw", ".tif.aux.xml"), "resolution": 1.0, "ready": True},
    ("pe3d", "dtm_xyz"): {"code": "5", "product": "dtm", "ready": False},
    ("pe3d", "intensity_hypsometry"): {"code": "6", "product": "imagery", "ready": False},
    ("copdem", "DGED-30"): {"type": "SAR_DGE_30_A4AD", "product": "dem", "ready": True},
    ("copdem", "DTED-30"): {"type": "SAR_DTE_30_615C", "product": "dem", "ready": True},
    ("copdem", "DGED-90"): {"type": "SAR_DGE_90_A407", "product": "dem", "ready": True},
    ("copdem", "DTED-90"): {"type": "SAR_DTE_90_61F6", "product": "dem", "ready": True},
}
# How a row of the file table names its file, and the count on each page.
SEQUENTIAL = r"(?i)^(?:target|linkDescDir(?:S3)?)_(\d+)$"
TOTAL = r"(?i)id=[\"']totalArchivos[\"'][^>]*value=[\"'](\d+)[\"']"
SHEET = r"^S[A-Z]-\d{2}-[VXYZ]-[ABCD]-(?:I|II|III|IV|V|VI)-[1-4]-(?:NO|NE|SO|SE)-[A-F]-(?:I|II|III|IV)$"
SHEET_HOSTS = ["pe3d.pe.gov.br", "www.pe3d.pe.gov.br"]
ZONE = r"(?i)-(ETRS89|REGCAN95)-H(\d{2})-"
#: Pages of one query, and files that may be taken without an account.
MOST_PAGES, QUOTA = 2000, 20


def product(portal: str, name: str) -> dict[str, Any]:
    """A product that can be had; one that the portal has but that is not ready is told from one that it has not."""
    if (portal, name) not in PRODUCTS:
        raise ValueError(f"{portal} has no product {name!r}, but {sorted(n for p, n in PRODUCTS if p == portal)}")
    found = PRODUCTS[portal, name]
    if not found["ready"]:
        raise ValueError(f"product {name!r} of {portal} is reserved")
    return found


def products(spark: SparkSession) -> DataFrame:
    """(portal, name, product, ready, code): the registry as a table."""
    return spark.createDataFrame([(p, n, v["product"], v["ready"], v.get("type") or v.get("code") or v.get("series")) for (p, n), v in sorted(PRODUCTS.items())], "portal string, name string, product string, ready boolean, code string")


# Tables of files


class _Rows(HTMLParser):
    """Text and ids of each table row; a row inside a row starts anew."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[str, list[str]]] = []
        self.text: list[str] | None = None
        self.ids: list[str] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "tr":
            self.text, self.ids = [], []
        elif self.text is not None:
            self.ids += [v for k, v in attrs if k == "id" and v]

    def handle_data(self, data: str) -> None:
        if self.text is not None:
            self.text.append(data)

    def handle_endtag(self, tag: str) -> None:
        if tag == "tr" and self.text is not None:
            self.rows.append((html.unescape(" ".join(self.text)), self.ids))
            self.text = None


def table_files(page: str, prefix: str) -> list[tuple[str, str]]:
    """(sequential, filename) of the rows of a page's tables that name both, each pair once; of several numbers in a row the last."""
    parser = _Rows()
    parser.feed(page or "")
    found: dict[tuple[str, str], None] = {}
    for text, ids in parser.rows:
        numbers = [m[1] for m in (re.match(SEQUENTIAL, i) for i in ids) if m]
        names = [n for n in re.findall(r"(?i)[^\s<>\"']+\.tiff?", text) if n.upper().startswith(prefix.upper())]
        if numbers and names:
            found[numbers[-1], names[0]] = None
    return list(found)


def page_total(page: str) -> int:
    said = re.search(TOTAL, page or "")
    if said is None:
        raise ValueError("the page does not tell how many files there are")
    return int(said[1])


def file_rows(pages: DataFrame, prefix: str, document: str = "document") -> DataFrame:
    """pages with sequential and filename, a row for each file that a page's tables name."""
    kind = T.ArrayType(T.StructType().add("sequential", T.StringType()).add("filename", T.StringType()))

    @F.pandas_udf(kind)
    def read(documents: pd.Series) -> pd.Series:
        return documents.map(lambda d: [{"sequential": s, "filename": f} for s, f in table_files(d, prefix)])

    rest = [c for c in pages.columns if c != document]
    return pages.select(*rest, F.inline(read(F.col(document))))


def paged_files(queries: DataFrame, post: Post, url: str, portal_product: dict[str, Any], workers: int = 4) -> DataFrame:
    """(query_id, sequential, filename) of queries (query_id, geometry as GeoJSON): pages are asked for until as many files came as the
    portal says there are, or a page has none. A number that stands for two files is an error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, geometry in zip(frame["query_id"], frame["geometry"], strict=True):
                area = json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {}, "geometry": json.loads(geometry)}]}, separators=(",", ":"))
                found: dict[str, str] = {}
                for number in range(1, MOST_PAGES + 2):
                    if number > MOST_PAGES:
                        raise ValueError(f"query {name} has over {MOST_PAGES} pages")
                    page = post(url, {"numPagina": str(number), "codAgr": portal_product["group"], "codSerie": portal_product["series"], "coordenadas": area})
                    new = table_files(page, portal_product["prefix"])
                    found |= new
                    if not new or len(found) >= page_total(page):
                        break
                yield pd.DataFrame([(name, s, f) for s, f in found.items()], columns=["query_id", "sequential", "filename"])

    out = queries.select("query_id", "geometry").repartition(workers, "query_id").mapInPandas(run, "query_id string, sequential string, filename string")
    names = out.groupBy("sequential").agg(F.min("filename").alias("a"), F.max("filename").alias("b"))
    checked = names.select("sequential", F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(F.raise_error(F.concat(F.lit("one number, two files: "), "a", F.lit(" and "), "b"))).alias("filename"))
    return out.select("query_id", "sequential").distinct().join(checked, "sequential").select("query_id", "sequential", "filename")


def one_footprint(answer: str) -> str:
    """The geometry, as GeoJSON, of an answer that has exactly one shape with an area."""
    shapes = json.loads(json.loads(answer)["coordsJson"]).get("features") or []
    geometry = shapes[0].get("geometry") if len(shapes) == 1 else None
    if not isinstance(geometry, dict) or geometry.get("type") not in ("Polygon", "MultiPolygon") or not geometry.get("coordinates"):
        raise ValueError("the answer has no single footprint")
    return json.dumps(geometry, separators=(",", ":"))


def footprints(files: DataFrame, cached: DataFrame, post: Post, url: str, workers: int = 4) -> DataFrame:
    """(sequential, geometry) of files: those that the cache has, and the others as the portal gives them."""
    wanted = files.select("sequential").distinct()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([(s, one_footprint(post(url, {"secuencial": s}))) for s in frame["sequential"]], columns=["sequential", "geometry"])

    fresh = wanted.join(cached, "sequential", "left_anti").repartition(workers, "sequential").mapInPandas(run, "sequential string, geometry string")
    return wanted.join(cached.select("sequential", "geometry"), "sequential").unionByName(fresh)


def read_cache(path: str) -> dict[str, Any]:
    """A cache of footprints; none, or one of another version, is empty."""
    try:
        with open(path, encoding="utf-8") as f:
            found = json.load(f)
        return found["footprints"] if found.get("schema_version") == 1 and isinstance(found.get("footprints"), dict) else {}
    except (OSError, ValueError, TypeError, AttributeError, KeyError):
        return {}


def write_cache(path: str, entries: dict[str, Any]) -> None:
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    with open(part, "w", encoding="utf-8") as f:
        json.dump({"schema_version": 1, "footprints": entries}, f, ensure_ascii=False, separators=(",", ":"))
    os.replace(part, path)


def within_quota(chosen: DataFrame, most: int = QUOTA, key: str = "filename") -> DataFrame:
    """The rows, if they name at most so many files; else an error as soon as rows are read."""
    count = chosen.agg(F.count_distinct(key).alias("_n"))
    checked = count.select(F.when(F.col("_n") <= most, True).otherwise(F.raise_error(F.format_string(f"%d files are more than the {most} that may be had", "_n"))).alias("_fits"))
    return chosen.join(F.broadcast(checked)).where("_fits").drop("_fits")  # one row


def zone_key(name: Column) -> Column:
    """The name without its zone: files of one sheet in several zones share it."""
    return F.upper(F.regexp_replace(name, ZONE, "-ZONE-"))


def zone_number(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, ZONE, 2), F.lit("")).cast("int")


def zone_system(name: Column) -> Column:
    """The system that a name tells, if it does: ETRS89 zones, and zone 28 of the Canaries."""
    datum, zone = F.upper(F.regexp_extract(name, ZONE, 1)), zone_number(name)
    return F.when(datum == "ETRS89", F.concat(F.lit("EPSG:"), (zone + 25800).cast("string"))).when((datum == "REGCAN95") & (zone == 28), "EPSG:4083")


def sheet_system(code: Column) -> Column:
    """The system of a 1:5000 sheet, by the zone in its code."""
    return F.concat(F.lit("EPSG:"), (31960 + F.split(code, "-")[1].cast("int")).cast("string"))


def choose_zones(met: DataFrame) -> DataFrame:
    """Of files of one sheet that a region meets (region_id, center_x, filename) the one in the zone of the region's centre, else the first by name."""
    own = F.least(F.lit(60), F.greatest(F.lit(1), F.floor((F.col("center_x") + 180) / 6) + 1))
    order = F.struct((F.coalesce(zone_number(F.col("filename")), F.lit(-1)) != own).alias("_other"), F.col("filename"))
    return met.withColumn("sheet", zone_key(F.col("filename"))).groupBy("region_id", "sheet").agg(F.min_by("filename", order).alias("filename"))


# Links in frames


def frame_sources(page: Column) -> Column:
    """The sources of all frames, in order; entities are resolved where they stand for an ampersand."""
    found = F.regexp_extract_all(page, F.lit(r"""(?i)<iframe\b[^>]*?\ssrc\s*=\s*["']([^"']+)["']"""), F.lit(1))
    return F.transform(found, lambda s: F.replace(s, F.lit("&amp;"), F.lit("&")))


@F.pandas_udf(T.StringType())
def unquoted(path: pd.Series) -> pd.Series:
    return path.map(lambda p: None if p is None else urllib.parse.unquote(p))


def sheet_downloads(pages: DataFrame, requested: DataFrame, base: str, spec: dict[str, Any], document: str = "document") -> DataFrame:
    """(sheet, url, filename) of archives that frames of the pages link to and that were requested (sheet).

    A link to another host is an error, as is a sheet with two archives; links to other scales and products are left out.
    """
    links = pages.select(F.explode(frame_sources(F.col(document))).alias("link"))
    full = F.when(F.col("link").rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.col("link")).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), F.ltrim(F.col("link"), F.lit("/"))))
    safe = F.when(trusted(full, SHEET_HOSTS), full).otherwise(F.raise_error(F.concat(F.lit("a link leads elsewhere: "), full)))
    read = links.select(safe.alias("url")).withColumn("path", unquoted(url_path(F.col("url")))).withColumn("filename", basename(F.col("path")))
    parts = F.transform(F.split("path", "/"), F.lower)
    prefix = spec["prefix"].lower()
    fits = F.array_contains(parts, spec["scale"].lower()) & F.array_contains(parts, spec["folder"].lower()) & F.lower("filename").startswith(prefix) & F.lower("filename").endswith(".zip")
    named = read.where(fits).withColumn("sheet", F.expr(f"substr(filename, {len(prefix) + 1}, length(filename) - {len(prefix) + 4})"))
    wanted = requested.select("sheet").distinct()
    wanted = wanted.select(F.when(F.col("sheet").rlike(SHEET), F.col("sheet")).otherwise(F.raise_error(F.concat(F.lit("no sheet code: "), "sheet"))).alias("sheet"))
    got = named.join(wanted, "sheet", "left_semi").groupBy("sheet").agg(F.min_by(F.struct("url", "filename"), "url").alias("d"), F.count_distinct("url").alias("n"))
    return got.select(F.when(F.col("n") == 1, F.col("sheet")).otherwise(F.raise_error(F.concat(F.lit("several archives of sheet "), "sheet"))).alias("sheet"), "d.*")


def link_batches(sheets: DataFrame, size: int = 100) -> DataFrame:
    """Sheets (sheet, portal_id) numbered in batches, as many as one question may name."""
    return batches(sheets.withColumn("_all", F.lit(1)), "sheet", size, "_all").drop("_all")


def resolve_sheets(planned: DataFrame, existing: DataFrame, catalogue: DataFrame, found: DataFrame) -> DataFrame:
    """(sheet, status, error): skipped where the file is there, failed where the catalogue or the portal has none, else planned."""
    out = planned.select("sheet").distinct().join(existing.select("sheet").distinct().withColumn("_there", F.lit(True)), "sheet", "left")
    out = out.join(catalogue.select("sheet").distinct().withColumn("_listed", F.lit(True)), "sheet", "left").join(found.select("sheet").distinct().withColumn("_found", F.lit(True)), "sheet", "left")
    status = F.when(F.col("_there"), "skipped").when(F.col("_listed").isNull() | F.col("_found").isNull(), "failed").otherwise("planned")
    error = F.when(F.col("_there").isNotNull(), None).when(F.col("_listed").isNull(), "the catalogue has no such sheet").when(F.col("_found").isNull(), "the portal has no archive of the sheet")
    return out.select("sheet", status.alias("status"), error.alias("error"))


# Searches and sessions


def grid_id(tile: Column) -> Column:
    """N41E111 of a tile's name."""
    part = lambda k: F.regexp_extract(tile, r"([NS])(\d{2})_00_([WE])(\d{3})_00", k)
    return F.concat(*(part(k) for k in (1, 2, 3, 4)))


def search_filter(tile: Column, form: str, resolution: str) -> Column:
    """The filter of a product search."""
    attribute = "Attributes/OData.CSC.StringAttribute/any(att:att/Name eq '{}' and att/OData.CSC.StringAttribute/Value eq '"
    head = f"Collection/Name eq 'CCM' and {attribute.format('productType')}{product('copdem', f'{form}-{resolution}')['type']}') and {attribute.format('gridId')}"
    return F.concat(F.lit(head), grid_id(tile), F.lit("')"))


class Refused(Exception):
    """An answer that another attempt does not mend."""


def get_json(url: str, attempts: int = 3, delay: float = 1.0, headers: dict[str, str] | None = None, sleep: Callable[[float], None] = time.sleep) -> Any:
    """A document, after waits that double. A refusal for want of a licence and a web page are told apart from faults that may pass."""
    for attempt in range(attempts):
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers=headers or {}), timeout=60) as answer:
                if answer.headers.get_content_type() == "text/html":
                    raise Refused("the answer is a web page")
                return json.load(answer)
        except urllib.error.HTTPError as e:
            if e.code == 403:
                raise Refused("refused: has the account accepted the licence?") from e
            if e.code < 500 and e.code not in (408, 429) or attempt == attempts - 1:
                raise
        except (OSError, ValueError):
            if attempt == attempts - 1:
                raise
        sleep(delay * 2**attempt)
    raise ValueError("attempts must be one at least")


@dataclass
class Session:
    """A token that is refreshed when it is old and fetched anew when the session is; clock and sign_in may be replaced.

    sign_in(None) signs in, sign_in(token) refreshes; both give (access, refresh)."""

    sign_in: Callable[[str | None], tuple[str, str | None]]
    clock: Callable[[], float] = time.monotonic
    session_s: float = 55 * 60
    token_s: float = 8 * 60
    access: str | None = None
    refresh: str | None = None
    _began: float = field(default=0.0, repr=False)
    _got: float = field(default=0.0, repr=False)

    def _anew(self) -> None:
        self.access, self.refresh = self.sign_in(None)
        self._began = self._got = self.clock()

    def token(self) -> str:
        now = self.clock()
        if self.access is None or now - self._began >= self.session_s or now - self._got >= self.token_s and not self.refresh:
            self._anew()
        elif now - self._got >= self.token_s:
            try:
                self.access, fresh = self.sign_in(self.refresh)
                self.refresh, self._got = fresh or self.refresh, now
            except (OSError, ValueError, KeyError):
                self._anew()
        return self.access

    def call(self, ask: Callable[[str], Any]) -> Any:
        """ask(token), and once more after signing in if the portal does not take the token."""
        try:
            return ask(self.token())
        except urllib.error.HTTPError as e:
            if e.code != 401:
                raise
            self._anew()
            return ask(self.access)


def sign_in_by_picture(fetch: Callable[[], bytes], post: Callable[[str], str], path: str, read: Callable[[str], str] = lambda p: input(f"{p}: "), attempts: int = 3) -> int:
    """Lets someone read a picture and posts what it says, until the portal says ok; the picture goes then. Gives the number of attempts."""
    for attempt in range(1, attempts + 1):
        os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
        with open(path + ".part", "wb") as f:
            f.write(fetch())
        os.replace(path + ".part", path)
        said = read(path).strip()
        if said and post(said).strip() == "ok":
            os.remove(path)
            return attempt
    raise Refused(f"no sign-in after {attempts} attempts; the last picture is {path}")


def cookie_header(cookies: dict[str, str]) -> dict[str, str]:
    """Cookies of a session as the header that tasks send."""
    return {"Cookie": "; ".join(f"{k}={v}" for k, v in cookies.items())} if cookies else {}


def verification(verify: bool = True, bundle: str | None = None) -> bool | str:
    """How answers' certificates are checked: by a bundle, which must be a file, by the system's, or not at all."""
    if bundle is None:
        return verify
    if not verify:
        raise ValueError("a bundle is of no use without verification")
    if not os.path.isfile(bundle):
        raise ValueError(f"{bundle} is no file")
    return bundle
