"""Fetching pages as a Spark data source: `spark.read.format("pages")`.

A partition holds the URLs of one host, so the spacing between requests to a host needs no
coordination and hosts are fetched side by side.  A page that is not there (404) is null without
an error; other failures are tried again after a wait that doubles, and then leave a null page
with its error, so that one page does not end a run; errors are counted by failures().
With the option `folder` nothing is fetched: host/path under it is the page.

Options: urls (one a line) or list (a text file with one a line), folder, spacing (seconds between
requests, 1), attempts (3), shortest and longest wait (2, 30), timeout (30), agent.
For URLs in a table, fetch() does the same with a shuffle by host.
"""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path
from urllib.parse import unquote, urlparse

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "url string, html string, status int, attempts int, error string"


@dataclass(frozen=True)
class Settings:
    folder: str = ""
    spacing: float = 1.0
    attempts: int = 3
    shortest: float = 2.0
    longest: float = 30.0
    timeout: float = 30.0
    agent: str = "kgloom"

    @classmethod
    def of(cls, options: dict[str, str]) -> Settings:
        known = {"folder": str, "spacing": float, "attempts": int, "shortest": float, "longest": float, "timeout": float, "agent": str}
        return cls(**{k: known[k](v) for k, v in options.items() if k in known})


def _from_folder(url: str, folder: str) -> tuple[str | None, int]:
    place = urlparse(url)
    root = Path(folder).resolve()
    path = (root / (place.hostname or "") / unquote(place.path).lstrip("/")).resolve()
    if root not in path.parents:
        return None, 404
    for option in (path, path / "index.html", path.with_name(path.name + ".html")):
        if option.is_file():
            return option.read_text(errors="replace"), 200
    return None, 404


def _from_host(url: str, settings: Settings) -> tuple[str | None, int]:
    request = urllib.request.Request(url, headers={"User-Agent": settings.agent})
    try:
        with urllib.request.urlopen(request, timeout=settings.timeout) as answer:
            return answer.read().decode(answer.headers.get_content_charset() or "utf-8", errors="replace"), answer.status
    except urllib.error.HTTPError as error:
        if error.code == 404:
            return None, 404
        raise


def pages_of_host(urls: Iterator[str], settings: Settings, sleep: Callable[[float], None] = time.sleep) -> Iterator[tuple]:
    """The rows of SCHEMA of one host's URLs, one after the other."""
    last = None
    for url in urls:
        tries, error, html, status = 0, None, None, None
        while tries < settings.attempts:
            tries += 1
            if last is not None and not settings.folder:
                sleep(max(0.0, settings.spacing - (time.monotonic() - last)))
            last = time.monotonic()
            try:
                html, status = _from_folder(url, settings.folder) if settings.folder else _from_host(url, settings)
                error = None
                break
            except (OSError, ValueError) as caught:
                error, status = f"{type(caught).__name__}: {caught}"[:200], getattr(caught, "code", None)
                if isinstance(caught, ValueError) and not isinstance(caught, OSError):
                    break  # no such kind of URL: trying again does not help
                if tries < settings.attempts:
                    sleep(min(settings.longest, settings.shortest * 2 ** (tries - 1)))
        yield url, html, status, tries, error


def host_of(url: str) -> str:
    try:
        return urlparse(url).netloc.lower()
    except ValueError:
        return ""


class HostUrls(InputPartition):
    def __init__(self, urls: list[str]) -> None:
        self.urls = urls


class PageReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.settings = Settings.of(options)
        text = Path(options["list"]).read_text() if "list" in options else options.get("urls", "")
        self.urls = list(dict.fromkeys(u.strip() for u in text.splitlines() if u.strip()))

    def partitions(self) -> list[HostUrls]:
        hosts: dict[str, list[str]] = {}
        for url in self.urls:
            hosts.setdefault(host_of(url), []).append(url)
        return [HostUrls(urls) for urls in hosts.values()] or [HostUrls([])]

    def read(self, partition: HostUrls) -> Iterator[tuple]:
        yield from pages_of_host(iter(partition.urls), self.settings)


class PageDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PageReader:
        return PageReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PageDataSource)


def fetch(urls: DataFrame, **options: str) -> DataFrame:
    """The rows of SCHEMA for a table of URLs (url): those of a host come to one task and follow one
    another there, without being held in memory."""
    settings = Settings.of(options)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = (r for rows in batches for r in zip(rows["host"], rows["url"], strict=True))
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        host, row = None, next(held, None)
        while row is not None:
            host = row[0]

            def of_host(first=row, host=host):
                nonlocal row
                row = first
                while row is not None and row[0] == host:
                    yield row[1]
                    row = next(held, None)

            for page in pages_of_host(of_host(), settings):
                yield pd.DataFrame([page], columns=names).astype({"status": "Int32", "attempts": "Int32"})

    hosts = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    rows = urls.where("url is not null").select("url").distinct().select(hosts.alias("host"), "url")
    return rows.repartition("host").sortWithinPartitions("host", "url").mapInPandas(run, SCHEMA)


def failures(rows: DataFrame) -> DataFrame:
    """host, pages, missing (404), failed of fetched rows."""
    host = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return rows.groupBy(host.alias("host")).agg(F.count("*").alias("pages"), F.count_if(F.col("status") == 404).alias("missing"), F.count_if(F.col("error").isNotNull()).alias("failed"))
