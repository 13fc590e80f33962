"""Merging feed rows to articles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.semantics import blank_to_null, feed_time, stripped


def merged_articles(rows: DataFrame) -> DataFrame:
    """(url, tickers, published_utc, publisher, sentiments, first_row) of feed rows (row_no, ticker, article_url, ...).

    Tickers in upper case in the order they are first seen; date and publisher of the first row; a ticker's sentiment is that of the row it
    is first seen in, if not blank. Two aggregations with map-side combination; no window, so a hot address or ticker sorts nothing.
    """
    clean = rows.filter(stripped(F.col("article_url")) != "").select(
        stripped(F.col("article_url")).alias("url"), "row_no", F.posexplode(F.filter(F.transform(F.split(F.coalesce("ticker", F.lit("")), ","), lambda x: F.upper(stripped(x))), lambda x: x != "")).alias("pos", "symbol"),
        F.struct(blank_to_null(F.col("sentiment")).alias("sentiment"), F.col("sentiment_reasoning").alias("reasoning")).alias("said"),
    )
    seen = clean.groupBy("url", "symbol").agg(F.min_by("said", F.struct("row_no", "pos")).alias("said"), F.min(F.struct("row_no", "pos")).alias("at"))
    symbols = seen.groupBy("url").agg(F.array_sort(F.collect_list(F.struct("at", "symbol", "said"))).alias("s"))
    heads = rows.filter(stripped(F.col("article_url")) != "").groupBy(stripped(F.col("article_url")).alias("url")).agg(F.min_by(F.struct(feed_time(F.col("published_utc")).alias("p"), blank_to_null(F.col("publisher_name")).alias("n")), "row_no").alias("h"), F.min("row_no").alias("first_row"))
    joined = heads.join(symbols, "url", "left")
    told = F.filter("s", lambda x: x["said"]["sentiment"].isNotNull())
    return joined.select("url", F.coalesce(F.transform("s", lambda x: x["symbol"]), F.array().cast("array<string>")).alias("tickers"), F.col("h.p").alias("published_utc"), F.col("h.n").alias("publisher"), F.map_from_entries(F.transform(told, lambda x: F.struct(x["symbol"], x["said"]))).alias("sentiments"), "first_row")


def distinct_pairs(rows: DataFrame) -> DataFrame:
    """The first feed row of each (ticker, address)."""
    named = rows.withColumns({"symbol": F.upper(stripped(F.col("ticker"))), "url": stripped(F.col("article_url"))}).filter((F.col("symbol") != "") & (F.col("url") != ""))
    return named.groupBy("symbol", "url").agg(F.min("row_no").alias("row_no"), F.count("*").alias("rows"))


def cursors(rows: DataFrame) -> DataFrame:
    """The newest instant of each ticker, from which the next poll starts."""
    return rows.groupBy(F.upper(stripped(F.col("ticker"))).alias("symbol")).agg(F.max(feed_time(F.col("published_utc"))).alias("newest"), F.count("*").alias("rows"))
