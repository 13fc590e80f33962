"""Precedents: what earlier articles and boxes are like an article, by a named strategy.

A strategy says what is searched (whole articles, their boxes, or boxes of the article's own ticker by date or by likeness), from
which labelled corpus, and whether a search of whole articles narrows the boxes first. Adding one is adding a row to `STRATEGIES`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions.vectors import nearest
from marketloom.operators.retrieval import box_hits

@dataclass(frozen=True)
class Strategy:
    """`what` is articles, boxes, newest or ticker; `label` a column of the boxes that is handed on; boxes labelled `leave_out` are no candidates (unlabelled ones are)."""

    what: str
    floor: float = -1.0
    limit: int = 60
    label: str | None = None
    leave_out: str | None = None
    article_floor: float | None = None


#: The names of the strategies.
STRATEGIES = {
    "article": Strategy("articles", limit=5),
    "insights": Strategy("boxes", floor=0.35),
    "distilled-first": Strategy("boxes", floor=0.35, label="first_label"),
    "distilled-second": Strategy("boxes", floor=0.35, label="second_label", leave_out="DROP"),
    "insights-hybrid": Strategy("boxes", floor=0.35, article_floor=0.3),
    "distilled-hybrid": Strategy("boxes", floor=0.35, label="second_label", leave_out="DROP", article_floor=0.3),
    "distilled-hybrid-one-pass": Strategy("boxes", floor=0.35, label="first_label", article_floor=0.3),
    "ticker-history": Strategy("newest", limit=15),
    "ticker-relevant": Strategy("ticker", limit=20),
}


def _best(hits: DataFrame, limit: int) -> DataFrame:
    """The `limit` best of (seed_article, id, similarity), each id once at its best."""
    best = hits.groupBy("seed_article", "id").agg(F.max("similarity").alias("similarity"))
    rank = F.row_number().over(Window.partitionBy("seed_article").orderBy(F.desc("similarity"), "id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= limit)


def seed_boxes(asking: DataFrame, boxes: DataFrame) -> DataFrame:
    """(seed_id, vector, article_id, us): the boxes of the asking articles."""
    return boxes.join(asking.select(F.col("id").alias("article_id")), "article_id", "left_semi").select(F.col("id").alias("seed_id"), "vector", "article_id", "us")


def own_ticker_seeds(asking: DataFrame, boxes: DataFrame) -> DataFrame:
    """(seed_id, vector, article_id, us, ticker): the boxes of the asking articles that have a primary ticker, the ticker as a hash."""
    own = asking.filter(F.col("primary_ticker").isNotNull()).select(F.col("id").alias("article_id"), F.xxhash64("primary_ticker").alias("ticker"))
    return boxes.select(F.col("id").alias("seed_id"), "vector", "article_id", "us").join(own, "article_id")


def of_ticker(seeds: DataFrame, touching: DataFrame, boxes: DataFrame, k: int) -> DataFrame:
    """(seed_id, id, similarity, rank): earlier boxes about the seed's ticker. The ticker is a condition on pairs of a block, not a join key, so a hot ticker is no hot key."""
    corpus = touching.select("article_id", F.xxhash64("ticker").alias("ticker")).join(boxes.select("id", "vector", "article_id", "us"), "article_id")
    return nearest(seeds, corpus.select("id", "vector", "article_id", "us", "ticker"), k, keep=lambda s, c: (s["ticker"] == c["ticker"]) & (c["us"] < s["us"]) & (s["article_id"] != c["article_id"]))


def precedents(name: str, articles: DataFrame, boxes: DataFrame, seeds: Column, touching: DataFrame | None = None) -> DataFrame:
    """(seed_article, id, label, similarity, rank) of every article that `seeds`, a condition on id, selects; id is an article's or a box's, by the strategy.

    articles (id, vector, us, primary_ticker), boxes (id, article_id, box_index, vector, us, plus label columns), us the article's instant in microseconds;
    touching (article_id, ticker) for the ticker's own boxes. Only what is earlier than the article counts, and never its own.
    """
    if name not in STRATEGIES:
        raise ValueError(f"unknown strategy {name!r}, expected one of {', '.join(STRATEGIES)}")
    s = STRATEGIES[name]
    asking = articles.filter(seeds)
    no_label = F.lit(None).cast("string").alias("label")
    if s.what == "articles":
        found = nearest(asking.select(F.col("id").alias("seed_id"), "vector", "us"), articles.select("id", "vector", "us"), s.limit, floor=s.floor, keep=lambda a, c: c["us"] < a["us"])
        return found.select(F.col("seed_id").alias("seed_article"), "id", no_label, "similarity", "rank")
    pool = boxes if s.leave_out is None else boxes.filter(~F.col(s.label).eqNullSafe(F.lit(s.leave_out)))
    if s.what == "newest":
        own = asking.filter(F.col("primary_ticker").isNotNull()).select(F.col("id").alias("seed_article"), F.col("primary_ticker").alias("ticker"), F.col("us").alias("until"))
        near = touching.join(own, "ticker").join(pool.select("id", "article_id", "box_index", "us"), "article_id").filter((F.col("us") < F.col("until")) & (F.col("article_id") != F.col("seed_article")))
        rank = F.row_number().over(Window.partitionBy("seed_article").orderBy(F.desc("us"), "article_id", "box_index"))
        return near.withColumn("rank", rank).filter(F.col("rank") <= s.limit).select("seed_article", "id", no_label, F.lit(None).cast("double").alias("similarity"), "rank")
    whole = articles.select(F.col("id").alias("article_id"), F.col("vector").alias("gate"))
    if s.what == "ticker":
        mine = own_ticker_seeds(asking, boxes)
        found = of_ticker(mine, touching, pool, s.limit)
    elif s.article_floor is not None:
        mine = seed_boxes(asking, pool).join(whole, "article_id")
        corpus = pool.join(whole, "article_id").select("id", "vector", "gate", "article_id", "us")
        found = nearest(mine, corpus, s.limit, floor=s.floor, keep=lambda a, c: c["us"] < a["us"], gate_floor=s.article_floor)
    else:
        mine = seed_boxes(asking, pool)
        found = box_hits(mine, pool.select("id", "vector", "article_id", "us"), k=s.limit, floor=s.floor)
    hits = found.join(mine.select("seed_id", F.col("article_id").alias("seed_article")), "seed_id").select("seed_article", "id", "similarity")
    best = _best(hits, s.limit)
    if s.label is None:
        return best.select("seed_article", "id", no_label, "similarity", "rank")
    return best.join(boxes.select("id", F.col(s.label).alias("label")), "id", "left").select("seed_article", "id", "label", "similarity", "rank")
