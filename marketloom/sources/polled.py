"""A streaming source that polls a feed per ticker, its offset the cursor of each ticker.

A ticker whose poll fails keeps its cursor, so nothing of it is lost and the others go on. The fetch function is given by the
caller: the library itself reaches no network.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, InputPartition, SimpleDataSourceStreamReader

SCHEMA = "ticker string, article_url string, published_utc string, publisher_name string, sentiment string, sentiment_reasoning string"
FIELDS = ("ticker", "article_url", "published_utc", "publisher_name", "sentiment", "sentiment_reasoning")


class JsonFolder:
    """Stand-in for a service: <folder>/<ticker>.json holds a list of articles."""

    def __init__(self, folder: str) -> None:
        self.folder = folder

    def __call__(self, ticker: str, since: str) -> list[dict]:
        with open(f"{self.folder}/{ticker}.json") as file:
            return sorted((a for a in json.load(file) if a["published_utc"] > since), key=lambda a: a["published_utc"])


def all_pages(fetch_page: Callable[[str, str, str | None], tuple[list[dict], str | None]], most: int = 1000) -> Callable[[str, str], list[dict]]:
    """A fetch function over one that gives a page and the cursor of the next (null after the last).

    An article on two pages comes once. A feed whose cursors don't end within `most` pages is an error, so that its ticker keeps its cursor.
    """

    def fetch(ticker: str, since: str) -> list[dict]:
        found: dict[str, dict] = {}
        cursor: str | None = None
        for _ in range(most):
            articles, cursor = fetch_page(ticker, since, cursor)
            for a in articles:
                found.setdefault(a["article_url"], a)
            if cursor is None:
                return sorted(found.values(), key=lambda a: a["published_utc"])
        raise ValueError(f"{ticker}: more than {most} pages")

    return fetch


class PolledReader(SimpleDataSourceStreamReader):
    def __init__(self, tickers: list[str], start: str, fetch: Callable[[str, str], list[dict]]) -> None:
        self.tickers, self.start, self.fetch = tickers, start, fetch

    def initialOffset(self) -> dict:  # noqa: N802
        return {t: self.start for t in self.tickers}

    def _polled(self, start: dict, end: dict | None) -> tuple[list[tuple], dict]:
        rows, cursor = [], dict(start)
        for ticker in self.tickers:
            since = start.get(ticker, self.start)
            try:
                articles = self.fetch(ticker, since)
            except Exception:  # noqa: BLE001, S112 - a failed ticker is polled again from its old cursor
                continue
            for a in articles:
                if end is not None and a["published_utc"] > end.get(ticker, since):
                    continue
                rows.append(tuple(a.get(f) if f != "ticker" else ticker for f in FIELDS))
                cursor[ticker] = max(cursor.get(ticker, since), a["published_utc"])
        return rows, cursor

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, cursor = self._polled(start, None)
        return iter(rows), cursor

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802
        return iter(self._polled(start, end)[0])


class PolledFeed(DataSource):
    """spark.dataSource.register(PolledFeed); readStream.format("polled_feed").option("tickers", "A,B").option("folder", ...)."""

    @classmethod
    def name(cls) -> str:
        return "polled_feed"

    def schema(self) -> str:
        return SCHEMA

    def simpleStreamReader(self, schema) -> PolledReader:  # noqa: N802, ANN001
        o = self.options
        return PolledReader([t.strip() for t in o["tickers"].split(",") if t.strip()], o.get("start", ""), JsonFolder(o["folder"]))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]
