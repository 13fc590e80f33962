from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from marketloom.functions import text, urls
from marketloom.functions.vectors import cosine_to, nearest
from marketloom.operators import asof, bars, feed, metrics, retrieval, upsert
from marketloom.operators.filters import SearchFilter
from marketloom.semantics import backoff_seconds, bucketed, contains, feed_time, market_date, months_before, overlaps, session_of


def at(text_: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text_)


def test_overlaps_and_contains_are_never_null(spark):
    rows = spark.createDataFrame([(1, ["A", None]), (2, None), (3, [])], "id int, a array<string>")
    got = {r.id: (r.o, r.c) for r in rows.select("id", overlaps(F.col("a"), ["A", "B"]).alias("o"), contains(F.col("a"), "A").alias("c")).collect()}
    assert got == {1: (True, True), 2: (False, False), 3: (False, False)}


def test_sessions_at_their_bounds(spark):
    cases = {"08:59": "closed", "09:00": "premarket", "14:29": "premarket", "14:30": "regular", "20:59": "regular", "21:00": "after_hours", "00:59": "after_hours", "01:00": "closed"}
    rows = spark.createDataFrame([(k, f"2025-01-07 {k}:00") for k in cases], "k string, t string")
    assert {r.k: r.s for r in rows.select("k", session_of(F.to_timestamp("t")).alias("s")).collect()} == cases


def test_market_date_of_late_evening_is_the_day_before(spark):
    row = spark.sql("SELECT timestamp'2025-01-07 04:30:00' AS t").select(market_date(F.col("t")).cast("string").alias("d")).first()
    assert row.d == "2025-01-06"


def test_months_before_clamps_to_the_month(spark):
    row = spark.sql("SELECT timestamp'2025-05-31 10:00:00' AS t").select(months_before(F.col("t"), 3).cast("string").alias("d")).first()
    assert row.d.startswith("2025-02-28 10:00")


def test_feed_time_reads_its_spellings(spark):
    rows = spark.createDataFrame([("2025-01-02T03:04:05Z",), ("2025-01-02T03:04:05+01:00",), ("2025-01-02 03:04:05",), ("2025-01-02",), ("not a date",), (None,), ("",)], "t string")
    got = [r.x and r.x.isoformat() for r in rows.select(feed_time(F.col("t")).alias("x")).collect()]
    assert got == ["2025-01-02T03:04:05", "2025-01-02T02:04:05", "2025-01-02T03:04:05", "2025-01-02T00:00:00", None, None, None]


def test_backoff_and_buckets(spark):
    rows = spark.createDataFrame([(0, 0.6999), (1, 0.7), (6, 0.85), (20, None)], "n int, c double")
    got = [(r.s, r.b) for r in rows.select(backoff_seconds(F.col("n")).alias("s"), bucketed(F.col("c"), [0.7, 0.85], ["low", "mid", "high"]).alias("b")).collect()]
    assert got == [(30, "low"), (60, "mid"), (1920, "high"), (3600, None)]


def test_urls(spark):
    cases = [
        ("https://WWW.Site.example:81/A/b/?utm_x=1&Ref=2&k=v&e=#top", "site.example:81", "https://www.site.example:81/A/b?k=v"),
        ("http://site.example", "site.example", "http://site.example/"),
        ("no address", "", "no address"),
        (None, None, None),
    ]
    rows = spark.createDataFrame([(c[0],) for c in cases], "u string")
    got = [(r.d, r.c) for r in rows.select(urls.domain_of(F.col("u")).alias("d"), urls.canonical_url(F.col("u")).alias("c")).collect()]
    assert got[0] == (cases[0][1], cases[0][2]) and got[1] == (cases[1][1], cases[1][2]) and got[3] == (None, None) and got[2][0] == ""


def test_text_checks(spark):
    rows = spark.createDataFrame([(200, "x" * 900), (404, "x" * 900), (None, "x" * 900), (200, "short"), (200, "Just a moment" + "x" * 900), (200, None)], "s int, h string")
    assert [r.b for r in rows.select(text.looks_bad(F.col("s"), F.col("h")).alias("b")).collect()] == [False, True, True, True, True, True]
    words = spark.createDataFrame([(" a  b\u00a0c ",), ("",), (None,)], "t string").select(text.word_count(F.col("t")).alias("n")).collect()
    assert [r.n for r in words] == [3, 0, 0]


def test_box_parts_and_headline(spark):
    box = "TOPIC: chips\nINSIGHT:  up \nQUOTES:\n- one\n\n two \n"
    row = spark.createDataFrame([(box,)], "b string").select(text.box_parts(F.col("b")).alias("p"), text.with_headline(F.col("b"), F.lit(" H ")).alias("h")).first()
    assert (row.p.topic, row.p.insight, row.p.quotes) == ("chips", "up", ["- one", " two"])
    assert row.h == "ARTICLE_HEADLINE: H\n" + box


def _naive_asof(left, right, forward, strict):
    out = {}
    for i, k, t in left:
        fits = [(rt, v) for rk, rt, v in right if rk == k and k is not None and t is not None and ((rt > t if strict else rt >= t) if forward else (rt < t if strict else rt <= t))]
        out[i] = (min(fits, key=lambda x: (x[0], x[1])) if forward else max(fits, key=lambda x: (x[0], -x[1])))[1] if fits else None
    return out


def test_asof_against_a_plain_loop(spark):
    rng = random.Random(4)
    left = [(i, rng.choice(["a", "b", "c", None]), rng.choice([rng.randrange(40), None])) for i in range(120)]
    right = [(rng.choice(["a", "b", "d"]), rng.randrange(40), i) for i in range(60)]
    a = spark.createDataFrame(left, "i int, k string, t int")
    b = spark.createDataFrame(right, "k string, t int, v int")
    for forward in (True, False):
        for strict in (True, False):
            for width in (None, 7, 1):
                got = asof.asof_join(a, b, by="k", left_time="t", right_time="t", direction="forward" if forward else "backward", strict=strict, slice_seconds=width).collect()
                assert len(got) == len(left) and {r.i: r.r_v for r in got} == _naive_asof(left, right, forward, strict), (forward, strict, width)


def test_nearest_with_slices_against_a_plain_loop(spark):
    rng = random.Random(6)
    left = [(i, rng.choice(["a", "b", None]), rng.choice([rng.randrange(60), None])) for i in range(80)]
    right = [(rng.choice(["a", "c"]), rng.randrange(60), i) for i in range(25)]
    a = spark.createDataFrame(left, "i int, k string, s int").select("i", "k", F.timestamp_seconds("s").alias("t"))
    b = spark.createDataFrame(right, "k string, s int, v int").select("k", F.timestamp_seconds("s").alias("t"), "v")
    want = {}
    for i, k, t in left:
        fits = [(abs(rt - t), rt > t, rt, v) for rk, rt, v in right if rk == k and t is not None]
        want[i] = min(fits)[3] if fits else None
    for width in (None, 11.0):
        got = asof.nearest_join(a, b, by="k", left_time="t", right_time="t", slice_seconds=width).collect()
        assert len(got) == len(left) and {r.i: r.r_v for r in got} == want, width


def test_a_hot_key_is_many_window_partitions(spark):
    a = spark.range(2000).select(F.lit("hot").alias("k"), F.col("id").alias("t"))
    b = spark.range(0, 2000, 3).select(F.lit("hot").alias("k"), F.col("id").alias("t"), F.col("id").alias("v"))
    joined = asof.asof_join(a, b, by="k", left_time="t", right_time="t", slice_seconds=50)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    each = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(each) > 1 and sum(each) == 2000


def test_asof_tolerance_and_nearest(spark):
    a = spark.createDataFrame([(1, "k", at("2025-01-01T10:00:00")), (2, "k", at("2025-01-01T20:00:00"))], "i int, k string, t timestamp")
    b = spark.createDataFrame([("k", at("2025-01-01T09:30:00"), 1.0), ("k", at("2025-01-01T10:20:00"), 2.0)], "k string, t timestamp, v double")
    got = asof.asof_join(a, b, by="k", left_time="t", right_time="t", tolerance_seconds=3600)
    assert {r.i: r.r_v for r in got.collect()} == {1: 1.0, 2: None}
    assert {r.i: r.r_v for r in asof.nearest_join(a, b, by="k", left_time="t", right_time="t").collect()} == {1: 2.0, 2: 2.0}


def test_next_day_over_a_weekend(spark):
    days = spark.createDataFrame([("x", dt.date(2025, 1, 10)), ("x", dt.date(2025, 1, 13)), ("x", dt.date(2025, 1, 13))], "k string, d date")
    assert {str(r.d): r.next_day and str(r.next_day) for r in asof.next_day(days, "k", "d").collect()} == {"2025-01-10": "2025-01-13", "2025-01-13": None}


def test_daily_ranges_across_utc_midnight(spark):
    rows = [("2025-03-03T15:10:00", 41.0, 41.5, 40.2, 41.1), ("2025-03-03T19:40:00", 41.1, 43.8, 41.0, 43.0), ("2025-03-04T03:59:00", 43.0, 43.1, 42.4, 42.5), ("2025-03-04T14:45:00", 42.0, 42.9, 39.5, 40.0), ("2025-03-04T18:05:00", 40.0, 40.4, 38.7, 39.9)]
    b = spark.createDataFrame([("n", at(r[0]), *r[1:]) for r in rows], "k string, t timestamp, o double, h double, l double, c double")
    got = {str(r.day): r for r in bars.with_moves(bars.daily_ranges(b, by="k", time="t", day=market_date(F.col("t")), low="l", high="h", open_="o", close="c")).collect()}
    first, second = got["2025-03-03"], got["2025-03-04"]
    assert (first.low, first.high, first.open, first.close, first.direction) == (40.2, 43.8, 41.0, 42.5, "up")
    assert (second.low, second.high, second.open, second.close, second.direction) == (38.7, 42.9, 42.0, 39.9, "down")


def test_first_bar_per_time(spark):
    b = spark.createDataFrame([("k", 1, 2, 9.0), ("k", 1, 1, 7.0), ("k", 2, 1, 5.0)], "k string, t int, n int, v double")
    assert {r.t: r.v for r in bars.first_per_time(b, "k", "t", "n").collect()} == {1: 7.0, 2: 5.0}


def test_feed_merge(spark):
    rows = [
        (1, "nvda", "u1", "2025-01-01T00:00:00Z", "positive", "r", "P"), (2, "AMD, NVDA", "u1", "2025-01-02T00:00:00Z", " ", "r", "Q"), (3, "AMD", "u1", None, "negative", "late", None),
        (4, "X", "  ", None, None, None, None), (5, None, "u2", "bad", None, None, ""), (6, "A,B", "u3", "2025-01-03", "neutral", "both", "R"),
    ]
    df = spark.createDataFrame(rows, "row_no bigint, ticker string, article_url string, published_utc string, sentiment string, sentiment_reasoning string, publisher_name string")
    got = {r.url: r for r in feed.merged_articles(df).collect()}
    assert set(got) == {"u1", "u2", "u3"}
    assert got["u1"].tickers == ["NVDA", "AMD"] and list(got["u1"].sentiments) == ["NVDA"] and got["u1"].publisher == "P"
    assert got["u2"].tickers == [] and got["u2"].published_utc is None
    assert set(got["u3"].sentiments) == {"A", "B"}


def test_upserts(spark):
    base = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    delta = spark.createDataFrame([(2, "B", "Z"), (3, "C", "Q")], "k int, v string, w string")
    got = sorted(map(tuple, upsert.upsert(base, delta, ["k"], keep=("w",)).collect()))
    assert got == [(1, "a", "x"), (2, "B", "y"), (3, "C", "Q")]
    assert sorted(map(tuple, upsert.upsert(base, delta, ["k"], null_on_update=("w",)).collect())) == [(1, "a", "x"), (2, "B", None), (3, "C", "Q")]
    assert sorted(map(tuple, upsert.insert_absent(base, delta, ["k"]).collect())) == [(1, "a", "x"), (2, "b", "y"), (3, "C", "Q")]
    assert [tuple(r) for r in upsert.delete(base, delta, ["k"]).collect()] == [(1, "a", "x")]
    holes = spark.createDataFrame([(1, None), (2, "b")], "k int, v string")
    assert sorted(map(tuple, upsert.set_if_null(holes, spark.createDataFrame([(1, "n"), (2, "m")], "k int, v string"), ["k"], "v").collect())) == [(1, "n"), (2, "b")]
    twice = spark.createDataFrame([(2, "B", "Z"), (2, "B2", "Z2"), (3, "C", "Q"), (3, "C2", "Q2")], "k int, v string, w string")
    assert sorted(map(tuple, upsert.upsert(base, twice, ["k"], order="v").collect())) == [(1, "a", "x"), (2, "B2", "Z2"), (3, "C2", "Q2")]
    assert sorted(map(tuple, upsert.insert_absent(base, twice, ["k"], order="w").collect())) == [(1, "a", "x"), (2, "b", "y"), (3, "C2", "Q2")]
    assert upsert.upsert(base, twice, ["k"]).count() == upsert.insert_absent(base, twice, ["k"]).count() == upsert.set_if_null(base, twice, ["k"], "v").count() + 1 == 3
    newest = spark.createDataFrame([(1, "o", 1), (1, "n", 2)], "k int, v string, s int")
    assert [r.v for r in upsert.latest(newest, ["k"], "s").collect()] == ["n"]


def test_filters(spark):
    rows = [(1, ["A"], "S", None, "d", at("2025-01-01T00:00:00")), (2, None, None, ["S"], "d", at("2025-01-31T23:00:00")), (3, ["B"], None, None, "e", None)]
    df = spark.createDataFrame(rows, "id int, tickers array<string>, primary_segment string, more_segments array<string>, source_domain string, published_utc timestamp")
    ids = lambda f: [r.id for r in df.filter(f.column()).orderBy("id").collect()]
    assert ids(SearchFilter()) == [1, 2, 3]
    assert ids(SearchFilter(tickers=("a", "b"))) == [1, 3]
    assert ids(SearchFilter(segment="S")) == [1, 2]
    assert ids(SearchFilter(until="2025-01-31")) == [1, 2]
    assert ids(SearchFilter(until="2025-01-31", until_exclusive=True)) == [1]
    assert ids(SearchFilter(domain="D", since="2025-01-02", exclude_id=1)) == [2]


def test_nearest_ties_floor_and_zero_vectors(spark):
    corpus = spark.createDataFrame([(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, [0.0, 1.0])], "id bigint, vector array<float>")
    seeds = spark.createDataFrame([(9, [3.0, 0.0])], "seed_id bigint, vector array<float>")
    assert [(r.id, r.similarity) for r in nearest(seeds, corpus, 1).collect()] == [(1, 1.0)]
    assert sorted(r.id for r in nearest(seeds, corpus, 9, floor=0.5).collect()) == [1, 2]
    assert [r.s for r in corpus.orderBy("id").select(cosine_to(F.col("vector"), [0.0, 5.0]).alias("s")).collect()] == [0.0, 0.0, None, 1.0]


def test_consolidation_prefers_best_then_matches_then_total(spark):
    hits = [(1, 7, 0.95), (1, 8, 0.90), (2, 8, 0.90), (3, 8, 0.90), (1, 9, 0.90), (1, 9, 0.80), (2, 9, 0.85)]
    df = spark.createDataFrame([("q", *h) for h in hits], "q string, seed_id int, article_id int, similarity double")
    top = retrieval.ranked(retrieval.consolidated(df, ["q"]), ["q"], 3).orderBy("rank").collect()
    assert [(r.article_id, r.matches) for r in top] == [(7, 1), (8, 3), (9, 2)]


def test_metrics(spark):
    df = spark.createDataFrame([(True, True), (True, None), (False, True), (False, False), (False, None)], "t boolean, s boolean")
    row = metrics.binary(df, F.col("t"), F.col("s")).first()
    assert (row.tp, row.fp, row.fn, row.tn) == (1, 2, 1, 1) and row.accuracy == 0.4
    assert metrics.binary(df.limit(0), F.col("t"), F.col("s"), empty=None).first().precision is None
    labels = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", None), (None, "c")], "t string, s string")
    got = {r.label: (r.tp, r.fp, r.fn) for r in metrics.per_class(labels, "t", "s").collect()}
    assert got == {"a": (1, 0, 1), "b": (0, 1, 1), "c": (0, 1, 0)}
    sets = spark.createDataFrame([([1, 2, 3], [2, 3, 4]), ([], None)], "e array<int>, r array<int>")
    cells = metrics.retrieval(sets, "e", "r").collect()
    assert abs(cells[0].f1 - 2 / 3) < 1e-12 and cells[1].f1 == 0.0
