"""Links, names, documents and times as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalized_link(url: Column) -> Column:
    """The first scheme with a single slash gets its second."""
    return F.regexp_replace(url, r"^(https?):/([^/])", "$1://$2")


def cache_key(url: Column) -> Column:
    """A readable part of the parent folder and eight digits of the whole."""
    parent = F.regexp_extract(url, r"([^/]*)/[^/]*$", 1)
    return F.concat_ws("_", F.regexp_replace(parent, r"[^A-Za-z0-9._-]", "_"), F.substring(F.md5(url.cast("binary")), 1, 8))


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def url_query(url: Column, key: str) -> Column:
    return F.regexp_extract(url, rf"[?&]{key}=([^&#]*)", 1)


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def extension(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"[^.](\.[^./]*)$", 1))


def suffixed(name: Column, suffix: str) -> Column:
    """name_suffix.ext; unchanged for an empty suffix."""
    return F.regexp_replace(name, r"^(.*?)(\.[^./]*)?$", f"$1_{suffix}$2") if suffix else name


def safe_component(name: Column) -> Column:
    """Whether a name can be one part of a path."""
    return name.isNotNull() & (F.length(name) > 0) & ~name.isin(".", "..") & ~name.rlike(r"[/\\]")


def trusted(url: Column, hosts: list[str]) -> Column:
    return F.lower(url).startswith("https://") & url_host(url).isin(*hosts)


def links(html: Column) -> Column:
    """The targets of all anchors, in order."""
    return F.regexp_extract_all(html, F.lit(r'<a[^>]*\shref="([^"]*)"'), F.lit(1))


def date_tag(date: Column) -> Column:
    """yymmdd of an ISO date's text."""
    return F.substring(F.replace(date, F.lit("-"), F.lit("")), 3, 6)


def iso_seconds(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
