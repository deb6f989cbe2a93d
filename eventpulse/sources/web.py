"""Feeds over HTTP as Spark data sources: executors ask for pages and archive hours, and offsets say what was asked.

``event_pages`` streams a paged feed of JSON arrays: (page, value), value being an item's text. A trigger looks at the feed's entity tag with one HEAD request and starts a batch only if it is a new one; the pages of a batch are read
by as many tasks. A batch that is run again asks again, so items may come twice: what follows deduplicates by id.

``event_archive`` reads gzip archive hours of a day: (hour, value), a line each, one task an hour.
"""

from __future__ import annotations

import gzip
import json
import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

TRIES, LONGEST_WAIT = 4, 60.0


def _open(url: str, method: str = "GET", headers: dict[str, str] | None = None):
    """An answer. Busy and failing servers are asked again, after the time that they name; other refusals raise."""
    for left in reversed(range(TRIES)):
        try:
            return urllib.request.urlopen(urllib.request.Request(url, headers=headers or {}, method=method), timeout=60)
        except urllib.error.HTTPError as e:
            if not left or (e.code != 429 and e.code < 500):
                raise
            named = e.headers.get("Retry-After") or ""
            time.sleep(min(LONGEST_WAIT, float(named) if named.isdigit() else 2.0 ** (TRIES - left)))
        except urllib.error.URLError:
            if not left:
                raise
            time.sleep(0.2 * 2 ** (TRIES - left))
    raise AssertionError("unreachable")


class Part(InputPartition):
    """A page or an hour by its number."""


class _Pages(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.url, self.count, self.token = options["url"], int(options.get("pages", "1")), options.get("token")
        self.tag, self.offset = "", self.initialOffset()

    def _headers(self) -> dict[str, str]:
        return {"Authorization": f"Bearer {self.token}"} if self.token else {}

    def initialOffset(self) -> dict[str, Any]:
        return {"at": 0, "tag": ""}

    def latestOffset(self) -> dict[str, Any]:
        try:
            with _open(self.url, "HEAD", self._headers() | ({"If-None-Match": self.tag} if self.tag else {})) as answer:
                tag = answer.headers.get("ETag") or ""
        except urllib.error.HTTPError as e:
            if e.code != 304:
                raise
            return self.offset
        if not tag or tag != self.tag:
            self.tag, self.offset = tag, {"at": time.time_ns(), "tag": tag}
        return self.offset

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [Part(k + 1) for k in range(self.count)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        mark = "&" if "?" in self.url else "?"
        with _open(f"{self.url}{mark}page={partition.value}", headers=self._headers()) as answer:
            for item in json.loads(answer.read()):
                yield partition.value, json.dumps(item, ensure_ascii=False)

    def commit(self, end: dict) -> None:
        pass


class EventPages(DataSource):
    """Options: url, pages (1), token."""

    @classmethod
    def name(cls) -> str:
        return "event_pages"

    def schema(self) -> str:
        return "page int, value string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Pages(dict(self.options))


class _Hours(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.url, self.day, self.hours = options["url"].rstrip("/"), options["day"], json.loads(options["hours"])

    def partitions(self) -> list[InputPartition]:
        return [Part(h) for h in self.hours]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        with _open(hour_url(self.url, self.day, partition.value)) as answer, gzip.open(answer, "rt", encoding="utf-8", newline="\n") as lines:
            for line in lines:
                if text := line.rstrip("\n"):
                    yield partition.value, text


class EventArchive(DataSource):
    """Options: url, day, hours (a JSON array)."""

    @classmethod
    def name(cls) -> str:
        return "event_archive"

    def schema(self) -> str:
        return "hour int, value string"

    def reader(self, schema) -> DataSourceReader:
        return _Hours(dict(self.options))


def hour_url(base: str, day: str, hour: int) -> str:
    return f"{base}/{day}-{hour}.json.gz"


def published(base: str, day: str, hour: int) -> bool:
    try:
        with _open(hour_url(base.rstrip("/"), day, hour), "HEAD"):
            return True
    except urllib.error.HTTPError as e:
        if e.code == 404:
            return False
        raise


def register(spark: SparkSession) -> SparkSession:
    for source in (EventPages, EventArchive):
        spark.dataSource.register(source)
    return spark
