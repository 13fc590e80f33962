from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.functions import boxes, pages, tagging
from marketloom.providers import HashEmbedder, KeywordClassifier, classified, embedded
from marketloom.sources import files, polled
from marketloom.streaming import feed

UNIVERSE = (("QLT", "Quillet Corporation", "Lenses"), ("BRS", "Brass River Mining", "Ores"), ("AI", "N7.bio", "Assays"), ("TMBR", "Tamber Technology", None), ("VV", "Vale & Vane", "Lenses"), ("TMB", None, None))


def test_dictionary_finds_names_symbols_and_marks():
    d = tagging.Dictionary(UNIVERSE)
    assert d.tickers("quillet CORPORATION and $BRS rose; Nasdaq: AI fell") == ["QLT", "BRS", "AI"]
    assert d.tickers("AI is everywhere (AI), and VV too") == []
    assert d.tickers("Tamber.") == []  # a full stop continues a name
    assert d.tickers("(AI +2.1%) beat N7.bio, Tamber and ( VV -3)") == ["AI", "TMBR", "VV"]
    assert d.tickers("vale & vane, NYSE VV and (TMB)") == ["VV", "TMB"]
    assert d.tickers("BRSX TMBRs xBRS İ Quillet Corporations") == []
    assert d.tickers("İ then Tamber") == ["TMBR"]
    assert d.tickers(None) == [] and d.tickers("") == [] and tagging.Dictionary(()).tickers("BRS") == []


def test_short_names():
    assert [tagging.short_name(x) for x in ("Tamber Technology", "Tamber", "Brass River Mining", "Global Systems", "Oak Group", "Quarrel Systems Holdings,")] == ["Tamber", None, None, None, None, "Quarrel"]


def test_annotation_is_idempotent():
    d = tagging.Dictionary(UNIVERSE)
    once = d.annotated("QLT beat Brass River Mining, QLT again. TMB (x) and Tamber (NYSE: TMBR)")
    assert once == "QLT (Quillet Corporation) beat Brass River Mining (BRS), QLT again. TMB (x) and Tamber (NYSE: TMBR)"
    assert d.annotated(once) == once and d.annotated(None) is None


def test_derived_tags(spark):
    table = spark.createDataFrame(UNIVERSE, "ticker string, company_name string, segment string")
    rows = [(1, [" brs ", "AI"], "t", "Quillet Corporation up"), (2, [], "t", "QLT"), (3, None, None, None), (4, ["QLT"], None, "QLT and $VV"), (5, ["zz", "AI", "BRS", "AI"], None, None), (4, ["QLT"], None, "QLT and $VV")]
    articles = spark.createDataFrame(rows, "id int, tickers array<string>, title string, content string")
    got = sorted((r.id, r.primary_ticker, r.primary_segment, r.more_tickers, r.more_segments) for r in tagging.derived_tags(articles, table).collect())
    four = (4, "QLT", "Lenses", ["VV"], None)
    assert got == [(1, "BRS", "Ores", ["AI", "QLT"], ["Assays", "Lenses"]), (2, *(None,) * 4), (3, *(None,) * 4), four, four, (5, "ZZ", None, ["AI", "BRS"], ["Assays", "Ores"])]


def test_quotes_are_spans_of_the_source():
    source = "In short: the harbour office sold four old cranes to a museum on Friday, and nobody complained about the price it fetched."
    align = lambda q: boxes.aligned_quotes([q], source)
    assert align('"sold four old cranes"') == (["sold four old cranes"], 0)
    assert align("- the harbor office sold four old cranes to the museum on Friday") == (["the harbour office sold four old cranes to a museum on Friday"], 0)
    assert align("sold four cranes to a museum") == (["sold four old cranes to a museum"], 0)
    assert align("a wholly different sentence about bread, butter and tea") == ([], 1)
    assert boxes.aligned_quotes(["old cranes", "“old cranes”", " ", "zzzz qqqq", None], source) == (["old cranes"], 3)
    assert boxes.aligned_quotes(None, None) == ([], 0) and boxes.aligned_quotes(["x"], None) == ([], 1)
    long = "word " * 50_000 + source
    assert boxes.aligned_quotes(["the harbour office sold four new cranes"], long) == (["the harbour office sold four old cranes"], 0)


def test_boxes_of_raw_completions():
    assert boxes.boxes_in('<think>{"boxes": ["no"]} hm</think>Here:\n```json\n{"boxes": ["TOPIC: tide", "  "]}\n```') == ["TOPIC: tide"]
    assert boxes.boxes_in('{"note": 1} {"boxes": [{"Topic": "t", "insight": "i", "quotes": "q"}]}') == ["TOPIC: t\nINSIGHT: i\nQUOTES:\nq"]
    assert boxes.boxes_in('{"boxes": [ { "TOPIC: {tide} \\"x\\"" }, {"topic": "u"}, 7]}') == ['TOPIC: {tide} "x"', "TOPIC: u\nINSIGHT: \nQUOTES:"]
    assert boxes.boxes_in('{"boxes": []} tail') == [] and boxes.boxes_in("no") is None and boxes.boxes_in(None) is None and boxes.boxes_in('{"boxes": ["cut') is None


def test_pages():
    page = pages.read_page("<title>T</title><nav>menu</nav><p>one <b>two</b></p><script>x</script><p>three</p>", least_words=1)
    assert page == {"title": "T", "text": "one two\nthree"}
    data = json.dumps({"@type": "NewsArticle", "articleBody": "the whole story"})
    assert pages.read_page(f'<script type="application/ld+json">{data}</script><p>short</p>')["text"] == "the whole story"
    assert pages.read_page(None) is None


def test_providers(spark):
    df = spark.createDataFrame([(1, "chips chips"), (2, " "), (3, None), (4, "boats")], "id bigint, text string")
    got = {r.id: r.embedding for r in embedded(df, HashEmbedder(16), id_col="id", text_col="text").collect()}
    assert set(got) == {1, 4} and abs(np.linalg.norm(got[1]) - 1) < 1e-6
    assert {r.id: r.label for r in classified(df, KeywordClassifier([("c", "chip")]), id_col="id", text_col="text").collect()} == {1: "c", 4: "other"}


def test_file_readers(spark, tmp_path):
    news = tmp_path / "news.csv"
    news.write_text("﻿tickers,article_url,published_utc,publisher_name\n\"A, b\",u1,2025-01-01T00:00:00Z,P\n, ,,\n", encoding="utf-8")
    jobs = files.scrape_jobs(spark, str(news)).collect()
    assert [(r.url, r.tickers, r.publisher) for r in jobs] == [("u1", ["A", "b"], "P")]
    assert files.news_csv(spark, str(news)).count() == 2
    ids = tmp_path / "ids.txt"
    ids.write_text("﻿12,\n\n 7 \n")
    assert sorted(r.id for r in files.id_list(spark, str(ids)).collect()) == [7, 12]
    ids.write_text("12\nx1\n")
    with pytest.raises(Exception, match="not an id"):
        files.id_list(spark, str(ids)).collect()
    clusters = tmp_path / "c.csv"
    clusters.write_text("theme,seed,found\nt,1,3 4  5\n,,\n")
    assert [r.found for r in files.clusters_csv(spark, str(clusters), ("found",)).collect()] == [[3, 4, 5]]
    with pytest.raises(ValueError, match="missing"):
        files.required(spark.range(1), ("x",))
    statements = tmp_path / "s.json"
    statements.write_text('[{"statement": "tolls rise", "scope": "segment", "scope_value": "Ores"}]')
    assert files.statements_json(spark, str(statements)).count() == 1
    universe = tmp_path / "u.csv"
    universe.write_text("ticker,company_name,segment\n a ,Acme, \n,x,y\n")
    assert [tuple(r) for r in files.universe_csv(spark, str(universe)).collect()] == [("A", "Acme", None)]


def test_polled_feed_keeps_the_cursor_of_failed_tickers(tmp_path):
    (tmp_path / "A.json").write_text(json.dumps([{"article_url": "u1", "published_utc": "2025-01-01"}, {"article_url": "u2", "published_utc": "2025-01-02"}]))
    reader = polled.PolledReader(["A", "B"], "", polled.JsonFolder(str(tmp_path)))
    start = reader.initialOffset()
    rows, end = reader.read(start)
    assert [r[1] for r in rows] == ["u1", "u2"] and end == {"A": "2025-01-02", "B": ""}
    assert list(reader.read(end)[0]) == []
    assert len(list(reader.readBetweenOffsets(start, {"A": "2025-01-01", "B": ""}))) == 1


def test_pages_are_followed_to_the_last():
    pages_ = {None: ([{"article_url": "u2", "published_utc": "2025-01-02"}], "x"), "x": ([{"article_url": "u1", "published_utc": "2025-01-01"}, {"article_url": "u2", "published_utc": "2025-01-02"}], None)}
    fetch = polled.all_pages(lambda ticker, since, cursor: pages_[cursor])
    assert [a["article_url"] for a in fetch("A", "")] == ["u1", "u2"]
    endless = polled.PolledReader(["A"], "s", polled.all_pages(lambda ticker, since, cursor: ([{"article_url": "u", "published_utc": "t"}], "again"), most=3))
    assert list(endless.read(endless.initialOffset())[0]) == [] and endless.read({"A": "s"})[1] == {"A": "s"}


def test_polled_feed_as_a_stream(spark, tmp_path):
    (tmp_path / "A.json").write_text(json.dumps([{"article_url": "u1", "published_utc": "2025-01-01T00:00:00Z"}]))
    spark.dataSource.register(polled.PolledFeed)
    stream = spark.readStream.format("polled_feed").option("tickers", "A,B").option("folder", str(tmp_path)).load()
    query = stream.writeStream.format("memory").queryName("polled").option("checkpointLocation", str(tmp_path / "cp")).start()
    query.processAllAvailable()
    query.stop()
    assert [(r.ticker, r.article_url) for r in spark.table("polled").collect()] == [("A", "u1")]


def test_streams_drain(spark, tmp_path):
    source = tmp_path / "in"
    rows = [("T", "u1", "2025-01-01T00:00:00Z"), ("T", "u1", "2025-01-01T01:00:00Z"), ("T", "u2", "2025-01-01T02:00:00Z"), ("T", " ", "2025-01-01T02:00:00Z")]
    spark.createDataFrame(rows, "ticker string, article_url string, published_utc string").coalesce(1).write.parquet(str(source))
    seen: list[str] = []
    stream = spark.readStream.schema("ticker string, article_url string, published_utc string").parquet(str(source))
    feed.drained(feed.new_articles(stream), lambda df, _: seen.extend(r.article_url for r in df.collect()), str(tmp_path / "c1"))
    assert sorted(seen) == ["u1", "u2"]


def test_last_state_and_sessions(spark, tmp_path):
    source = tmp_path / "in"
    spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, "q")], "key string, stamp bigint, value string").coalesce(1).write.parquet(str(source))
    out: list[tuple] = []
    stream = spark.readStream.schema("key string, stamp bigint, value string").parquet(str(source))
    feed.drained(feed.last_states(stream), lambda df, _: out.extend(map(tuple, df.collect())), str(tmp_path / "c2"), "update")
    assert sorted(out) == [("a", 3, "z", 3), ("b", 1, "q", 1)]
    batch = spark.createDataFrame([("k", "2025-01-01 00:00:00"), ("k", "2025-01-01 00:10:00"), ("k", "2025-01-01 02:00:00")], "k string, t string").select("k", F.to_timestamp("t").alias("t"))
    assert sorted(r.events for r in feed.sessions(batch, by="k", time="t").collect()) == [1, 2]
