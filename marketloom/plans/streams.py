"""Streams drained over the data folder: file source, one pass over all that is there, results as Parquet in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.plans import ingest  # noqa: F401 - its SQL is used here
from marketloom.plans.registry import ORACLE_SQL, Tables, query
from marketloom.session import shared_folder
from marketloom.streaming import feed


def _stream(t: Tables, name: str) -> DataFrame:
    return t.spark.readStream.schema(getattr(t, name).schema).parquet(f"{t.folder}/{name}.parquet*")  # a pattern, as the table may be a file or a folder


def _drained(t: Tables, stream: DataFrame) -> DataFrame:
    """The stream's rows, written by the streaming sink and read back."""
    place = f"{shared_folder(t.spark)}/stream-{uuid.uuid4().hex}"
    stream.writeStream.format("parquet").option("path", f"{place}/rows").option("checkpointLocation", f"{place}/log").trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.schema(stream.schema).parquet(f"{place}/rows")


@query(r"""
WITH c AS (SELECT article_url, regexp_replace(published_utc, '^[\s\x{00A0}]+|[\s\x{00A0}]+$', '', 'g') AS p FROM news_csv WHERE trim(article_url) <> '')
SELECT DISTINCT article_url FROM c WHERE coalesce(try_strptime(regexp_replace(p, 'Z$', '+00:00'), '%Y-%m-%dT%H:%M:%S%z')::TIMESTAMPTZ, timezone('UTC', try_strptime(p, '%Y-%m-%d %H:%M:%S')), timezone('UTC', try_strptime(p, '%Y-%m-%d'))) IS NOT NULL
""")
def stream_new_articles(t: Tables) -> DataFrame:
    """Each address once within the watermark."""
    return _drained(t, feed.new_articles(_stream(t, "news_csv"), "24 hours").select("article_url"))


def _closed(t: Tables, events: DataFrame, name: str) -> DataFrame:
    """The stream and one closing record, ten days after the table's last row and without a key, that moves the watermark past all of it."""
    place = f"{shared_folder(t.spark)}/closing-{uuid.uuid4().hex}"
    last = getattr(t, name).agg((F.max("ts").cast("timestamp") + F.expr("interval 10 days")).alias("ts"))
    last.select(*[F.col("ts") if c == "ts" else F.lit(None).cast(events.schema[c].dataType).alias(c) for c in events.columns]).write.parquet(place)
    return events.unionByName(t.spark.readStream.schema(events.schema).parquet(place))


@query("""SELECT user_id, epoch_us(date_trunc('day', ts)) AS day_us, min(value) AS low, max(value) AS high, count(*) AS bars FROM events WHERE user_id IS NOT NULL GROUP BY user_id, date_trunc('day', ts)""")
def stream_daily_ranges(t: Tables) -> DataFrame:
    """Low, high and count per key and day; a closing record lets the last days out."""
    bars = _stream(t, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    out = _drained(t, feed.daily_ranges(_closed(t, bars, "events"), by="user_id", time="ts", price="value"))
    return out.filter("user_id IS NOT NULL").select("user_id", F.unix_micros("day").alias("day_us"), "low", "high", "bars")


@query("""
WITH f AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 12 HOURS THEN 1 ELSE 0 END AS cut FROM events WHERE user_id IS NOT NULL),
s AS (SELECT *, sum(cut) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM f)
SELECT user_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) + 43200000000 AS end_us, count(*) AS events FROM s GROUP BY user_id, run
""")
def stream_sessions(t: Tables) -> DataFrame:
    """Runs of a key's events with less than twelve hours between them."""
    events = _stream(t, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    out = _drained(t, feed.sessions(_closed(t, events, "events"), by="user_id", time="ts", gap="12 hours"))
    return out.filter("user_id IS NOT NULL").select("user_id", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"), "events")


@query(ORACLE_SQL["feed_merge_by_url"].replace("coalesce(tickers, '') AS tickers, published_us, publisher, coalesce(sentiments, '') AS sentiments, first_row", "coalesce(tickers, '') AS tickers, first_row"))
def stream_merged_articles(t: Tables) -> DataFrame:
    """Tickers merged per address within each poll, and the polls' rows merged again: no ticker of an address is lost."""
    place = f"{shared_folder(t.spark)}/polls-{uuid.uuid4().hex}"
    feed.merged_polls(_stream(t, "news_csv"), f"{place}/rows", f"{place}/log")
    return feed.merged_again(t.spark.read.parquet(f"{place}/rows")).select("url", F.array_join("tickers", ",").alias("tickers"), "first_row")
