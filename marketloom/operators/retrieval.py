"""Searches by similarity, their consolidation and precedents."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions.vectors import cosine_to, nearest
from marketloom.operators.filters import SearchFilter


def usable(df: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows with a vector that has a direction."""
    return df.filter(F.col(column).isNotNull() & (F.size(column) > 0) & F.exists(column, lambda x: x != 0))


def seed_vector(df: DataFrame, condition: Column, id_col: str = "id") -> tuple[int, list[float]] | None:
    """The one row that the condition selects first, by id: a point lookup."""
    row = usable(df.filter(condition)).select(id_col, "embedding").orderBy(id_col).limit(1).collect()
    return (row[0][0], list(row[0][1])) if row else None


def similar_articles(articles: DataFrame, vector: list[float], *, k: int, where: SearchFilter, floor: float = -1.0) -> DataFrame:
    """(id, similarity) of the k most similar articles that pass the filter; the floor is applied after the limit.

    The filter is applied before any similarity is computed; the top k is taken per task first.
    """
    rows = usable(articles.filter(where.column()))
    scored = rows.select("id", cosine_to(F.col("embedding"), vector).alias("similarity"))
    return scored.orderBy(F.desc("similarity"), "id").limit(k).filter(F.col("similarity") >= floor)


def consolidated(hits: DataFrame, by: list[str], article: str = "article_id") -> DataFrame:
    """Hits of (by, seed_id, article, similarity) as one row per article: best, matches and total of its best hits per seed."""
    best = hits.groupBy(*by, "seed_id", article).agg(F.max("similarity").alias("s"))
    return best.groupBy(*by, article).agg(F.max("s").alias("best"), F.count("*").alias("matches"), F.sum("s").alias("total"))


def ranked(groups: DataFrame, by: list[str], k: int, *, article: str = "article_id") -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("best"), F.desc("matches"), F.desc("total"), article)
    return groups.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def box_hits(seeds: DataFrame, boxes: DataFrame, *, k: int, floor: float, window_days: int | None = None) -> DataFrame:
    """(seed_id, id, similarity, rank): seed boxes against boxes of other, earlier articles.

    Both have id (seeds: seed_id), vector, article_id and us, the article's instant in microseconds.
    """
    reach = window_days * 86_400_000_000 if window_days else None

    def earlier(s: dict, c: dict) -> np.ndarray:
        good = (s["article_id"] != c["article_id"]) & (c["us"] < s["us"])
        return good if reach is None else good & (c["us"] >= s["us"] - reach)

    return nearest(seeds, boxes, k, floor=floor, keep=earlier)
