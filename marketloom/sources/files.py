"""Readers of the file formats, each with a fixed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.semantics import blank_to_null, feed_time, stripped

NEWS_FIELDS = ("ticker", "article_url", "published_utc", "sentiment", "sentiment_reasoning", "publisher_name")


def _csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """All columns as text; a byte-order mark before the first name is dropped."""
    df = spark.read.csv(path, header=True, sep=sep, multiLine=True, escape='"', encoding="UTF-8", inferSchema=False)
    return df.withColumnsRenamed({c: c.lstrip("﻿") for c in df.columns if c.startswith("﻿")})


def required(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def news_csv(spark: SparkSession, path: str) -> DataFrame:
    """Feed rows with row_no, their place in the file order."""
    df = _csv(spark, path)
    names = {"tickers": "ticker"} if "tickers" in df.columns and "ticker" not in df.columns else {}
    df = required(df.withColumnsRenamed(names), ("ticker", "article_url"))
    for c in NEWS_FIELDS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    return df.select(F.monotonically_increasing_id().alias("row_no"), *NEWS_FIELDS)


def scrape_jobs(spark: SparkSession, path: str) -> DataFrame:
    """(url, tickers, published_utc, publisher) of each row with an address; tickers as they are spelled."""
    df = _csv(spark, path)
    listed = F.coalesce(*[F.when(F.trim(c) != "", F.col(c)) for c in ("tickers", "ticker") if c in df.columns], F.lit(""))
    symbols = F.filter(F.transform(F.split(listed, ","), lambda x: stripped(x)), lambda x: x != "")
    return df.filter(stripped(F.col("article_url")) != "").select(stripped(F.col("article_url")).alias("url"), symbols.alias("tickers"), feed_time(F.col("published_utc")).alias("published_utc"), blank_to_null(F.col("publisher_name")).alias("publisher"))


def universe_csv(spark: SparkSession, path: str) -> DataFrame:
    df = _csv(spark, path)
    return df.select(F.upper(F.trim("ticker")).alias("ticker"), blank_to_null(F.col("company_name")).alias("company_name"), blank_to_null(F.col("segment")).alias("segment")).filter(F.col("ticker") != "")


def clusters_csv(spark: SparkSession, path: str, id_columns: tuple[str, ...]) -> DataFrame:
    """Columns of ids parted by blanks, as arrays; rows without a theme are dropped."""
    df = _csv(spark, path)
    ids = lambda c: F.array_compact(F.transform(F.split(F.trim(F.coalesce(c, F.lit(""))), r"\s+"), lambda x: x.try_cast("bigint")))
    return df.filter(F.trim(df.columns[0]) != "").withColumns({c: ids(F.col(c)) for c in id_columns if c in df.columns})


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """(id) of a text file with an id a line; marks and commas at its ends are dropped, a line that is no id is an error."""
    lines = spark.read.text(path).select(F.regexp_replace("value", "^﻿|[,\\s]+$|^\\s+", "").alias("v")).filter(F.col("v") != "")
    return lines.select(F.coalesce(F.col("v").try_cast("bigint"), F.raise_error(F.concat(F.lit("not an id: "), "v")).cast("bigint")).alias("id"))


def statements_json(spark: SparkSession, path: str) -> DataFrame:
    """(scope, scope_value, statement) of a JSON list; each needs a statement."""
    df = spark.read.json(path, multiLine=True, schema="statement string, scope string, scope_value string")
    return df.withColumn("statement", F.when(F.trim("statement") != "", F.col("statement")).otherwise(F.raise_error(F.lit("a statement is missing"))))


def tsv(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, sep="\t")


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """One file with a header; nulls are empty. For reports: the rows go through one task."""
    df.coalesce(1).write.mode("overwrite").csv(path, header=True, sep=sep, nullValue="", emptyValue="")
