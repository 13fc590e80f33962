from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from marketloom.functions import text
from marketloom.operators import precedents, queue, upsert
from marketloom.operators.filters import SearchFilter, scoped
from marketloom.streaming import feed


def _corpus(spark):
    articles = spark.createDataFrame([(1, [1.0, 0.0], 100, "A"), (2, [1.0, 0.1], 50, "A"), (3, [0.0, 1.0], 60, "B"), (4, [1.0, 0.0], 200, "A")], "id bigint, vector array<float>, us bigint, primary_ticker string")
    rows = [(10, 1, 0, [1.0, 0.0], 100, "x"), (11, 1, 1, [0.0, 1.0], 100, "DROP"), (20, 2, 0, [1.0, 0.2], 50, "x"), (21, 2, 1, [0.9, 0.1], 50, "DROP"), (30, 3, 0, [1.0, 0.05], 60, None), (40, 4, 0, [1.0, 0.0], 200, "x")]
    boxes = spark.createDataFrame(rows, "id bigint, article_id bigint, box_index int, vector array<float>, us bigint, second_label string").withColumn("first_label", F.lit("one"))
    touching = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B"), (4, "A")], "article_id bigint, ticker string")
    return articles, boxes, touching


def test_every_strategy_looks_back_only(spark):
    articles, boxes, touching = _corpus(spark)
    found = {name: [(r.id, r.label) for r in precedents.precedents(name, articles, boxes, F.col("id") == 1, touching).orderBy("rank").collect()] for name in precedents.STRATEGIES}
    assert [i for i, _ in found["article"]] == [2, 3]
    assert found["insights"] == [(30, None), (21, None), (20, None)]
    assert found["distilled-first"] == [(30, "one"), (21, "one"), (20, "one")]
    assert found["distilled-second"] == [(30, None), (20, "x")]  # an unlabelled box is none that is left out
    assert [i for i, _ in found["insights-hybrid"]] == [21, 20]  # the article of box 30 is too far as a whole
    assert found["distilled-hybrid"] == [(20, "x")] and found["distilled-hybrid-one-pass"] == [(21, "one"), (20, "one")]
    assert [i for i, _ in found["ticker-history"]] == [20, 21] and [i for i, _ in found["ticker-relevant"]] == [21, 20]
    with pytest.raises(ValueError, match="unknown strategy"):
        precedents.precedents("nothing", articles, boxes, F.lit(True), touching)


def test_scopes():
    assert scoped(None, None) == scoped(" Sector ", "x") == SearchFilter()
    assert scoped("ticker", "A").tickers == ("A",) and scoped("segment", "S").segment == "S"
    for bad in (("ticker", None), ("planet", "x")):
        with pytest.raises(ValueError, match="says nothing"):
            scoped(*bad)


def test_queue_steps(spark):
    jobs = spark.createDataFrame([("a", "running", 0, None), ("b", "running", 4, None), ("c", "running", 1, None), ("d", "failed", 5, "old"), ("e", "pending", 2, None)], "article_url string, status string, attempts int, last_error string").withColumn("next_attempt_at", F.timestamp_seconds(F.lit(0)))
    failures = spark.createDataFrame([("a", "timeout", False), ("b", "timeout", None), ("c", "gone", True), ("c", "gone", False)], "article_url string, error string, permanent boolean")
    now = F.timestamp_seconds(F.lit(1000))
    after = {r.article_url: (r.status, r.attempts, r.last_error, r.s) for r in queue.after_failures(jobs, failures, now).withColumn("s", F.unix_seconds("next_attempt_at")).collect()}
    assert after == {"a": ("pending", 1, "timeout", 1030), "b": ("failed", 5, "timeout", 0), "c": ("failed", 2, "gone", 0), "d": ("failed", 5, "old", 0), "e": ("pending", 2, None, 0)}
    assert {r.article_url: (r.status, r.attempts) for r in queue.requeued(jobs, now, F.col("article_url") != "z").collect()}["d"] == ("pending", 0)
    assert {r.status for r in queue.recovered(jobs).collect()} == {"pending", "failed"}


def test_token_cut(spark):
    rows = spark.createDataFrame([(1, "one two  three\nfour five"), (2, " "), (3, None), (4, "short")], "id int, t string")
    assert [r.c for r in rows.orderBy("id").select(text.cut_to_tokens(F.col("t"), 3, passing=10).alias("c")).collect()] == ["one two  three", " ", " ", "short"]


def test_readiness(spark):
    articles = spark.createDataFrame([(1, "ok", "2025-01-01", "x"), (2, "error", "2025-01-01", "x"), (3, "ok", None, " ")], "id int, status string, published_utc string, content string")
    wanted = spark.createDataFrame([(1,), (2,), (3,), (9,)], "article_id int")
    assert upsert.readiness(wanted, articles).first().asDict() == {"wanted": 4, "missing": 1, "not_ok": 1, "without_content": 1, "without_date": 1, "usable": 1}
    with pytest.raises(ValueError, match="3 of 4"):
        upsert.checked_ready(wanted, articles)
    assert upsert.checked_ready(wanted.filter("article_id = 1"), articles).count() == 1


def test_polls_keep_every_ticker(spark, tmp_path):
    columns = "row_no bigint, ticker string, article_url string, published_utc string, sentiment string, sentiment_reasoning string, publisher_name string"
    for number, rows in enumerate(([(1, "A", "u1", "2025-01-01", None, None, "P"), (2, "B", "u1", "2025-01-01", None, None, "P")], [(3, "C", "u1", "2025-01-02", None, None, "Q"), (4, "A", "u2", None, None, None, None)])):
        spark.createDataFrame(rows, columns).coalesce(1).write.parquet(str(tmp_path / "in" / f"d{number}"))
    stream = spark.readStream.schema(columns).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    feed.merged_polls(stream, str(tmp_path / "out"), str(tmp_path / "log"))
    polls = spark.read.parquet(str(tmp_path / "out"))
    assert polls.select("poll").distinct().count() == 2
    assert {r.url: (r.tickers, r.publisher) for r in feed.merged_again(polls).collect()} == {"u1": (["A", "B", "C"], "P"), "u2": (["A"], None)}
