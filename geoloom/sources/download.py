"""Downloads as a table: each request gets a row with its status, and its file appears whole or not at all."""

from __future__ import annotations

import fcntl
import os
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE = 1 << 20
RESULT = "filename string, status string, path string, bytes long, error string"


class Unfit(Exception):
    """An answer that no retry mends."""


def _fetch(url: str, place: str, form: dict[str, str] | None, timeout: float) -> None:
    """Appends to what an earlier attempt left. An answer to a range that starts elsewhere, and one in full, start anew."""
    part = place + ".part"
    have = os.path.getsize(part) if os.path.exists(part) else 0
    request = urllib.request.Request(url, urllib.parse.urlencode(form).encode() if form else None, {"Accept-Encoding": "identity"})
    if have:
        request.add_header("Range", f"bytes={have}-")
    try:
        answer = urllib.request.urlopen(request, timeout=timeout)
    except urllib.error.HTTPError as e:
        said = e.headers.get("Content-Range", "")
        if e.code == 416 and have and said.rpartition("/")[2] == str(have):  # the file was whole already
            os.replace(part, place)
            return
        if e.code == 416 and have:
            os.remove(part)
        elif e.code < 500 and e.code not in (408, 429):
            raise Unfit(f"HTTP {e.code}") from e
        raise
    with answer:
        if answer.headers.get_content_type() == "text/html":
            raise Unfit("the answer is a web page")
        if answer.headers.get("Content-Encoding", "identity") != "identity":
            raise Unfit("the answer is encoded")
        resumed = answer.status == 206 and answer.headers.get("Content-Range", "").startswith(f"bytes {have}-")
        if answer.status == 206 and not resumed:
            raise OSError("the answer starts at another byte than was asked for")
        length = answer.headers.get("Content-Length")
        want = int(length) + (have if resumed else 0) if length else None
        with open(part, "ab" if resumed else "wb") as f:
            while piece := answer.read(PIECE):
                f.write(piece)
            got = f.tell()
    if want is not None and got != want:
        raise OSError(f"{got} bytes of {want}")
    os.replace(part, place)


def fetch(url: str, place: str, retries: int = 3, delay: float = 2.0, form: dict[str, str] | None = None, timeout: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> None:
    """One file, with retries more attempts after waits that double. A lock keeps two attempts of a task from adding to one part."""
    os.makedirs(os.path.dirname(place), exist_ok=True)
    with open(place + ".lock", "w") as lock:
        fcntl.flock(lock, fcntl.LOCK_EX)
        for attempt in range(retries + 1):
            try:
                _fetch(url, place, form, timeout)
                break
            except OSError:  # of which HTTP and URL errors are kinds
                if attempt == retries:
                    raise
                sleep(delay * 2**attempt)
    os.remove(place + ".lock")


def download(requests: DataFrame, folder: str, retries: int = 3, delay: float = 2.0, overwrite: bool = False, workers: int = 8, materialize: Callable[[str, str | None], str] | None = None, product: Callable[[str], str] | None = None) -> DataFrame:
    """(filename, status, path, bytes, error) for a frame (url, filename), each filename once.

    requests may have form, a map to be posted, and detail, a text for materialize. This turns a file that came into its product, in the same
    task, and gives the product's path; product tells that path beforehand, so that a product that is there spares the download.

    status is success, skipped (the file was there) or failed. workers bounds the connections that are open at once, as
    each task holds one. folder must be one that all executors share; a task that runs again goes on from what is there.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for url, name, form, detail in zip(frame["url"], frame["filename"], frame["form"], frame["detail"], strict=True):
                place, status, error = os.path.join(folder, name or ""), "success", None
                made = product(place) if product and name else None
                if not name or name in (".", "..") or "/" in name or "\\" in name:
                    status, error = "failed", f"{name!r} cannot be a file name"
                elif made and os.path.exists(made) and not overwrite:
                    status, place = "skipped", made
                elif not made and os.path.exists(place) and not overwrite:
                    status = "skipped"
                else:
                    try:
                        fetch(url, place, retries, delay, None if form is None else dict(form))
                    except (OSError, Unfit, ValueError) as e:
                        status, error = "failed", str(e) or type(e).__name__
                    if error is None and materialize is not None:
                        try:
                            place = materialize(place, detail)
                        except (OSError, ValueError) as e:  # a file that cannot be converted counts as failed
                            status, error = "failed", str(e) or type(e).__name__
                good = error is None
                yield pd.DataFrame([(name, status, place if good else None, os.path.getsize(place) if good else None, error)], columns=["filename", "status", "path", "bytes", "error"]).astype({"bytes": "Int64"})

    form = F.col("form") if "form" in requests.columns else F.lit(None).cast("map<string,string>")
    detail = F.col("detail") if "detail" in requests.columns else F.lit(None).cast("string")
    return requests.select("url", "filename", form.alias("form"), detail.alias("detail")).repartition(workers, "filename").mapInPandas(run, RESULT)
