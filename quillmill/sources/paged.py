"""Paged remote sources as Python data sources; the transport is injected.

``PagedSource`` reads pages ``(cursor) -> (rows, next cursor or None)``, as a batch and as a stream.
The stream's offset is the cursor, so that a restart resumes with the page after the last one that
was committed; the sink must be idempotent by id, since a page may be delivered twice.
"""

from __future__ import annotations

import time
import xml.etree.ElementTree as ElementTree
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

ATOM = {"atom": "http://www.w3.org/2005/Atom", "arxiv": "http://arxiv.org/schemas/atom"}
Page = Callable[[str], tuple[list[tuple], str | None]]
_transports: dict[str, Page] = {}


def register_transport(name: str, fetch: Page) -> None:
    """Name a page function for the ``transport`` option; it must be importable where it runs."""
    _transports[name] = fetch


class RemoteError(Exception):
    """A failed call with the server's status, if it answered, and its wish to wait."""

    def __init__(self, status: int | None = None, retry_after: float = 0.0):
        super().__init__(f"status {status}")
        self.status, self.retry_after = status, retry_after


def with_retries(call: Callable[[], object], attempts: int = 5, base: float = 5.0, sleep: Callable[[float], None] = time.sleep):
    """Result of ``call``; overload, server and transport errors are tried again after a pause."""
    for attempt in range(1, attempts + 1):
        try:
            return call()
        except RemoteError as error:
            lasting = error.status is not None and error.status not in (429, 500, 502, 503, 504)
            if lasting or attempt == attempts:
                raise
            sleep(max(error.retry_after, base * 2 ** (attempt - 1)))
    raise ValueError("at least one attempt is needed")


class PagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.fetch, self.start, self.pages = _transports[options["transport"]], options.get("start", "*"), int(options.get("pages", "1000000"))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(self.start)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        cursor: str | None = partition.value
        for _ in range(self.pages):
            if cursor is None:
                return
            rows, cursor = self.fetch(cursor)
            yield from rows


class PagedStream(SimpleDataSourceStreamReader):
    """One page a batch; an exhausted cursor is remembered, never turned into a fresh start."""

    def __init__(self, options: dict[str, str]):
        self.fetch, self.start = _transports[options["transport"]], options.get("start", "*")

    def initialOffset(self) -> dict:
        return {"cursor": self.start}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        if start["cursor"] is None:
            return iter(()), start
        rows, following = self.fetch(start["cursor"])
        return iter(rows), {"cursor": following}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter(self.fetch(start["cursor"])[0]) if start["cursor"] is not None else iter(())

    def commit(self, end: dict) -> None:
        pass


class PagedSource(DataSource):
    """``spark.read.format("paged").schema(...).option("transport", name)``."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "id string"

    def reader(self, schema) -> PagedReader:
        return PagedReader(self.options)

    def simpleStreamReader(self, schema) -> PagedStream:
        return PagedStream(self.options)


def parse_feed(xml: str) -> list[tuple]:
    """Entries of an Atom page: id, title, published, updated, summary, categories, pdf link, license."""

    def text(entry, path: str) -> str:
        return " ".join((entry.findtext(path, "", ATOM) or "").split())

    rows = []
    for entry in ElementTree.fromstring(xml).iterfind("atom:entry", ATOM):
        links = [a.attrib for a in entry.iterfind("atom:link", ATOM)]
        pdf = next((a.get("href", "") for a in links if a.get("title") == "pdf" or a.get("type") == "application/pdf"), "")
        terms = [c.attrib["term"] for c in entry.iterfind("atom:category", ATOM) if c.attrib.get("term")]
        if text(entry, "atom:id"):
            rows.append((text(entry, "atom:id"), text(entry, "atom:title"), text(entry, "atom:published"), text(entry, "atom:updated") or None, text(entry, "atom:summary"), terms, pdf, text(entry, "arxiv:license") or None))
    return rows


FEED = "id string, title string, published string, updated string, summary string, categories array<string>, pdf string, license string"
