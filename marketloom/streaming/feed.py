"""Streams of feed rows and events."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from marketloom.operators.feed import merged_articles
from marketloom.semantics import feed_time


def new_articles(rows: DataFrame, lookback: str = "24 hours") -> DataFrame:
    """Feed rows with an address, each address once within the lookback; state older than it is dropped."""
    timed = rows.withColumn("published", feed_time(F.col("published_utc"))).filter((F.trim("article_url") != "") & F.col("published").isNotNull())
    return timed.withWatermark("published", lookback).dropDuplicatesWithinWatermark(["article_url"])


def merged_polls(rows: DataFrame, place: str, checkpoint: str) -> None:
    """Drains a stream of feed rows; each batch is merged per address and written to a folder of its own, so that a batch that comes twice is written once."""

    def poll(batch: DataFrame, number: int) -> None:
        merged_articles(batch).select("url", "tickers", "published_utc", "publisher", "first_row").write.mode("overwrite").parquet(f"{place}/poll={number}")

    drained(rows, poll, checkpoint)


def merged_again(polls: DataFrame) -> DataFrame:
    """One row per address of rows merged poll by poll: tickers as first seen, date and publisher of the first row."""
    parts = polls.groupBy("url").agg(F.array_sort(F.collect_list(F.struct("first_row", "tickers"))).alias("p"), F.min_by(F.struct("published_utc", "publisher"), "first_row").alias("h"), F.min("first_row").alias("first_row"))
    return parts.select("url", F.array_distinct(F.flatten(F.transform("p", lambda x: x["tickers"]))).alias("tickers"), "h.published_utc", "h.publisher", "first_row")


def daily_ranges(bars: DataFrame, *, by: str, time: str, price: str, delay: str = "1 day") -> DataFrame:
    """Low, high and count per key and day of a stream of prices, closed when the watermark passes the day."""
    return bars.withWatermark(time, delay).groupBy(F.window(time, "1 day").alias("w"), by).agg(F.min(price).alias("low"), F.max(price).alias("high"), F.count("*").alias("bars")).select(by, F.col("w.start").alias("day"), "low", "high", "bars")


def sessions(events: DataFrame, *, by: str, time: str, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """Events per key in runs without a longer gap."""
    return events.withWatermark(time, delay).groupBy(F.session_window(time, gap).alias("w"), by).agg(F.count("*").alias("events")).select(by, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "events")


class LastState(StatefulProcessor):
    """Keeps the newest row of each key and how many rows it had: the stream form of a keyed state table."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("last", "stamp bigint, value string, rows bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        stamp, value, count = self.state.get() if self.state.exists() else (-1, None, 0)
        for frame in rows:
            newest = frame.loc[frame["stamp"].idxmax()]
            count += len(frame)
            if newest["stamp"] >= stamp:
                stamp, value = int(newest["stamp"]), newest["value"]
        self.state.update((stamp, value, count))
        yield pd.DataFrame({"key": [key[0]], "stamp": [stamp], "value": [value], "rows": [count]})

    def close(self) -> None:
        pass


def last_states(rows: DataFrame) -> DataFrame:
    """(key, stamp, value, rows) of a stream (key string, stamp bigint, value string). Needs the RocksDB state store."""
    return rows.groupBy("key").transformWithStateInPandas(LastState(), "key string, stamp bigint, value string, rows bigint", "Update", "None")


def drained(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Runs the stream over all that is there and stops; each batch goes to `sink`, which must bear being given a batch twice."""
    stream.writeStream.foreachBatch(sink).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
