"""Bars, sessions, as-of joins, calendars and attachments. Events stand for bars: user_id is the key, value the price."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketloom.operators import asof, bars
from marketloom.plans.registry import Tables, query
from marketloom.semantics import market_date, market_time, session_of, stripped

_BARS = "b AS (SELECT event_id, user_id, ts, value, CAST(timezone('America/New_York', timezone('UTC', ts)) AS DATE) AS day FROM events)"


WEEK = 7 * 86_400.0  # as-of joins cut a key into slices of so many seconds


def _bars(t: Tables) -> DataFrame:
    return t.events.select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "value", "event_type")


def _ranges(t: Tables) -> DataFrame:
    return bars.daily_ranges(_bars(t), by="user_id", time="ts", day=market_date(F.col("ts")), low="value", high="value", open_="value", close="value")


_RANGES = f"""{_BARS}, r AS (
  SELECT user_id, day, min(value) AS low, arg_min(ts, (value, ts)) AS low_time, max(value) AS high, arg_min(ts, (-value, ts)) AS high_time, arg_min(value, ts) AS open, arg_max(value, ts) AS close
  FROM b GROUP BY user_id, day)"""


@query(f"WITH {_RANGES} SELECT user_id, CAST(day AS VARCHAR) AS day, low, epoch_us(low_time) AS low_us, high, epoch_us(high_time) AS high_us, open, close FROM r")
def daily_ranges_market_day(t: Tables) -> DataFrame:
    """Open, high, low and close of the exchange's day, with the first times of low and high."""
    return _ranges(t).select("user_id", F.col("day").cast("string").alias("day"), "low", F.unix_micros("low_time").alias("low_us"), "high", F.unix_micros("high_time").alias("high_us"), "open", "close")


@query(f"""WITH {_RANGES} SELECT user_id, CAST(day AS VARCHAR) AS day, CASE WHEN low > 0 THEN (high - low) / low * 100 END AS range_pct, CASE WHEN open > 0 THEN (close - open) / open * 100 END AS net_pct,
       CASE WHEN low_time <= high_time THEN 'up' ELSE 'down' END AS direction FROM r""")
def daily_moves(t: Tables) -> DataFrame:
    return bars.with_moves(_ranges(t)).select("user_id", F.col("day").cast("string").alias("day"), "range_pct", "net_pct", "direction")


@query(f"""WITH {_RANGES}, i AS (SELECT CAST(timezone('America/New_York', timezone('UTC', ts)) AS DATE) AS day, (max(value) - min(value)) / min(value) * 100 AS index_pct FROM events WHERE event_type = 'view' AND value > 0 GROUP BY 1)
SELECT user_id, CAST(r.day AS VARCHAR) AS day, (high - low) / low * 100 AS range_pct FROM r JOIN i ON r.day = i.day WHERE low > 0 AND (high - low) / low * 100 >= 500 AND index_pct > 1000""")
def range_scan_with_index(t: Tables) -> DataFrame:
    """Wide days of a key on days on which the index moved as well."""
    day = market_date(F.col("ts"))
    index = _bars(t).filter("event_type = 'view' AND value > 0").groupBy(day.alias("day")).agg(((F.max("value") - F.min("value")) / F.min("value") * 100).alias("index_pct"))
    wide = bars.with_moves(_ranges(t)).filter("range_pct >= 500")
    return wide.join(index.filter("index_pct > 1000"), "day").select("user_id", F.col("day").cast("string").alias("day"), "range_pct")


@query("""
SELECT event_id, CASE WHEN m >= 240 AND m < 570 THEN 'premarket' WHEN m >= 570 AND m < 960 THEN 'regular' WHEN m >= 960 AND m < 1200 THEN 'after_hours' ELSE 'closed' END AS session
FROM (SELECT event_id, hour(l) * 60 + minute(l) AS m FROM (SELECT event_id, timezone('America/New_York', timezone('UTC', ts)) AS l FROM events))
""")
def session_label(t: Tables) -> DataFrame:
    return _bars(t).select("event_id", session_of(F.col("ts")).alias("session"))


_NEWS = "n AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'error'), q AS (SELECT user_id, ts, min(value) AS value FROM events WHERE event_type = 'purchase' GROUP BY ALL)"


def _news_and_prices(t: Tables) -> tuple[DataFrame, DataFrame]:
    b = _bars(t)
    prices = b.filter("event_type = 'purchase'").groupBy("user_id", "ts").agg(F.min("value").alias("value"))
    return b.filter("event_type = 'error'").select("event_id", "user_id", "ts"), prices


@query(f"WITH {_NEWS} SELECT n.event_id, q.value, epoch_us(q.ts) AS us FROM n ASOF LEFT JOIN q ON n.user_id = q.user_id AND n.ts <= q.ts")
def asof_forward(t: Tables) -> DataFrame:
    """The first price at or after each item."""
    news, prices = _news_and_prices(t)
    joined = asof.asof_join(news, prices, by="user_id", left_time="ts", right_time="ts", direction="forward", slice_seconds=WEEK)
    return joined.select("event_id", F.col("r_value").alias("value"), F.unix_micros("r_ts").alias("us"))


@query(f"""WITH {_NEWS} SELECT event_id, CASE WHEN d <= 14400000000 THEN value END AS value, CASE WHEN d <= 14400000000 THEN us END AS us
FROM (SELECT n.event_id, q.value, epoch_us(q.ts) AS us, epoch_us(n.ts) - epoch_us(q.ts) AS d FROM n ASOF LEFT JOIN q ON n.user_id = q.user_id AND n.ts >= q.ts)""")
def asof_backward_tolerance(t: Tables) -> DataFrame:
    """The last price at or before each item, not older than four hours."""
    news, prices = _news_and_prices(t)
    joined = asof.asof_join(news, prices, by="user_id", left_time="ts", right_time="ts", tolerance_seconds=14_400, slice_seconds=WEEK)
    return joined.select("event_id", F.col("r_value").alias("value"), F.unix_micros("r_ts").alias("us"))


@query(f"""WITH {_NEWS}, b AS (SELECT n.event_id, q.value, epoch_us(n.ts) - epoch_us(q.ts) AS d FROM n ASOF LEFT JOIN q ON n.user_id = q.user_id AND n.ts >= q.ts),
f AS (SELECT n.event_id, q.value, epoch_us(q.ts) - epoch_us(n.ts) AS d FROM n ASOF LEFT JOIN q ON n.user_id = q.user_id AND n.ts <= q.ts)
SELECT b.event_id, CASE WHEN b.d IS NOT NULL AND (f.d IS NULL OR b.d <= f.d) THEN b.value ELSE f.value END AS value FROM b JOIN f USING (event_id)""")
def asof_nearest(t: Tables) -> DataFrame:
    news, prices = _news_and_prices(t)
    return asof.nearest_join(news, prices, by="user_id", left_time="ts", right_time="ts", slice_seconds=WEEK).select("event_id", F.col("r_value").alias("value"))


@query(f"""WITH {_BARS}, d AS (SELECT DISTINCT user_id, day FROM b) SELECT user_id, CAST(day AS VARCHAR) AS day, CAST(lead(day) OVER (PARTITION BY user_id ORDER BY day) AS VARCHAR) AS next_day FROM d""")
def next_trading_day(t: Tables) -> DataFrame:
    days = _bars(t).select("user_id", market_date(F.col("ts")).alias("day"))
    return asof.next_day(days, "user_id", "day").select("user_id", F.col("day").cast("string").alias("day"), F.col("next_day").cast("string").alias("next_day"))


@query("""
WITH s AS (SELECT id, list_distinct([upper(trim(y)) FOR y IN list_concat([primary_ticker], coalesce(more_tickers, [])) IF trim(y) <> '']) AS a, timezone('America/New_York', published_utc) AS l FROM articles WHERE published_utc IS NOT NULL),
e AS (SELECT id, unnest(a) AS ticker, CAST(l AS DATE) AS d, hour(l) AS h FROM s)
SELECT ticker, CAST(day AS VARCHAR) AS day, count(*) AS articles, count(*) FILTER (WHERE kind = 'prev-after-hours') AS late, CAST(sum(id) AS BIGINT) AS ids
FROM (SELECT id, ticker, d AS day, 'same-day' AS kind FROM e UNION ALL SELECT id, ticker, d + 1, 'prev-after-hours' FROM e WHERE h >= 16) GROUP BY ticker, CAST(day AS VARCHAR)
""")
def attach_articles_to_days(t: Tables) -> DataFrame:
    """Articles belong to their day, and to the next calendar day when they came after the close."""
    local = market_time(F.col("published_utc"))
    symbols = F.array_distinct(F.filter(F.transform(F.concat(F.array("primary_ticker"), F.coalesce("more_tickers", F.array().cast("array<string>"))), lambda x: F.upper(stripped(x))), lambda x: x.isNotNull() & (x != "")))
    rows = t.articles.filter(F.col("published_utc").isNotNull()).select("id", F.explode(symbols).alias("ticker"), F.to_date(local).alias("d"), F.hour(local).alias("h"))
    same = F.struct(F.col("d").alias("day"), F.lit("same-day").alias("kind"))
    late = F.struct(F.date_add("d", 1).alias("day"), F.lit("prev-after-hours").alias("kind"))
    keys = rows.select("id", "ticker", F.explode(F.when(F.col("h") >= 16, F.array(same, late)).otherwise(F.array(same))).alias("k"))
    return keys.groupBy("ticker", F.col("k.day").cast("string").alias("day")).agg(F.count("*").alias("articles"), F.count_if(F.col("k.kind") == "prev-after-hours").alias("late"), F.sum("id").alias("ids"))


@query("""
WITH b AS (SELECT *, CAST(timezone('America/New_York', timezone('UTC', ts)) AS DATE) AS day, row_number() OVER (PARTITION BY user_id, CAST(timezone('America/New_York', timezone('UTC', ts)) AS DATE) ORDER BY ts, event_id) AS r,
 hour(timezone('America/New_York', timezone('UTC', ts))) * 60 + minute(timezone('America/New_York', timezone('UTC', ts))) AS m FROM events)
SELECT user_id, CAST(day AS VARCHAR) AS day, min(r) FILTER (WHERE m < 570) AS pre_first, max(r) FILTER (WHERE m < 570) AS pre_last, min(r) FILTER (WHERE m >= 960) AS post_first, max(r) FILTER (WHERE m >= 960) AS post_last FROM b GROUP BY user_id, day
""")
def session_spans(t: Tables) -> DataFrame:
    """Positions of the bars before the opening and after the close."""
    local = market_time(F.col("ts"))
    rows = _bars(t).withColumns({"day": F.to_date(local), "m": F.hour(local) * 60 + F.minute(local)})
    rows = rows.withColumn("r", F.row_number().over(Window.partitionBy("user_id", "day").orderBy("ts", "event_id")))
    pre, post = F.when(F.col("m") < 570, F.col("r")), F.when(F.col("m") >= 960, F.col("r"))
    return rows.groupBy("user_id", F.col("day").cast("string").alias("day")).agg(F.min(pre).alias("pre_first"), F.max(pre).alias("pre_last"), F.min(post).alias("post_first"), F.max(post).alias("post_last"))


@query("""SELECT event_type, user_id, count(*) AS n, avg(value) AS mean, grouping(event_type, user_id) AS level FROM events GROUP BY GROUPING SETS ((event_type, user_id), (event_type), ())""")
def grouping_sets_summary(t: Tables) -> DataFrame:
    t.events.createOrReplaceTempView("marketloom_events")
    return t.spark.sql("SELECT event_type, user_id, count(*) AS n, avg(value) AS mean, grouping_id(event_type, user_id) AS level FROM marketloom_events GROUP BY event_type, user_id GROUPING SETS ((event_type, user_id), (event_type), ())")


@query("""SELECT o_orderstatus AS status, o_orderpriority AS priority, count(*) AS n FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)""")
def rollup_counts(t: Tables) -> DataFrame:
    return t.orders.rollup(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")).agg(F.count("*").alias("n"))


@query("""SELECT o_orderstatus AS status, o_orderpriority AS priority, max(o_totalprice) AS most FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""")
def cube_maxima(t: Tables) -> DataFrame:
    return t.orders.cube(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")).agg(F.max("o_totalprice").alias("most"))


@query("""SELECT event_id, sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS last5, rank() OVER (PARTITION BY user_id ORDER BY value DESC) AS place, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events""")
def window_frames(t: Tables) -> DataFrame:
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return t.events.select("event_id", F.sum("value").over(order.rowsBetween(-4, 0)).alias("last5"), F.rank().over(Window.partitionBy("user_id").orderBy(F.desc("value"))).alias("place"), F.lag("value").over(order).alias("before"))


@query("""
WITH f AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL 12 HOURS THEN 1 ELSE 0 END AS cut FROM events),
s AS (SELECT *, sum(cut) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM f)
SELECT user_id, CAST(run AS BIGINT) AS run, count(*) AS events, epoch_us(min(ts)) AS start_us FROM s GROUP BY user_id, run
""")
def gap_sessions(t: Tables) -> DataFrame:
    """Runs of a key's events without a gap of more than twelve hours."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = _bars(t)
    gap = F.unix_micros("ts") - F.lag(F.unix_micros("ts")).over(order)
    cut = rows.withColumn("cut", F.when(gap > 43_200_000_000, 1).otherwise(0)).withColumn("run", F.sum("cut").over(order))
    return cut.groupBy("user_id", "run").agg(F.count("*").alias("events"), F.unix_micros(F.min("ts")).alias("start_us"))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def json_props_extract(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("""SELECT user_id, count(*) FILTER (WHERE event_type = 'view') AS view, count(*) FILTER (WHERE event_type = 'click') AS click, count(*) FILTER (WHERE event_type = 'purchase') AS purchase FROM events GROUP BY user_id""")
def pivot_counts(t: Tables) -> DataFrame:
    kinds = ["view", "click", "purchase"]
    return t.events.groupBy("user_id").pivot("event_type", kinds).count().na.fill(0, kinds)


@query("""SELECT user_id FROM events WHERE event_type = 'purchase' INTERSECT SELECT user_id FROM events WHERE event_type = 'error' EXCEPT SELECT user_id FROM events WHERE event_type = 'signup' AND value > 480""")
def set_operations(t: Tables) -> DataFrame:
    of = lambda c: t.events.filter(c).select("user_id")
    return of("event_type = 'purchase'").intersect(of("event_type = 'error'")).subtract(of("event_type = 'signup' AND value > 480"))


@query("""SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_linenumber, l_partkey) AS parts, count(*) AS n FROM lineitem GROUP BY l_orderkey""")
def ordered_collect(t: Tables) -> DataFrame:
    parts = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey")))
    return t.lineitem.groupBy("l_orderkey").agg(F.array_join(F.transform(parts, lambda x: x["l_partkey"].cast("string")), ",").alias("parts"), F.count("*").alias("n"))


@query("""SELECT n_name, count(*) AS orders, max(o_totalprice) AS most FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name""")
def dimension_join(t: Tables) -> DataFrame:
    return t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).join(F.broadcast(t.nation), F.col("n_nationkey") == F.col("c_nationkey")).groupBy("n_name").agg(F.count("*").alias("orders"), F.max("o_totalprice").alias("most"))


@query("""SELECT user_id, epoch_us(date_trunc('hour', ts)) AS hour_us, arg_min(value, event_id) AS value FROM events GROUP BY user_id, date_trunc('hour', ts)""")
def bars_first_per_time(t: Tables) -> DataFrame:
    """Of several bars at one time the first counts."""
    rows = _bars(t).select("user_id", F.date_trunc("hour", "ts").alias("hour"), "event_id", "value")
    return bars.first_per_time(rows, "user_id", "hour", "event_id").select("user_id", F.unix_micros("hour").alias("hour_us"), "value")


@query("""
WITH i AS (SELECT event_id AS iid, user_id, ts AS a, ts + INTERVAL 6 HOUR AS b FROM events WHERE event_type = 'error')
SELECT iid, count(*) AS inside, sum(value) AS total FROM i JOIN events e ON e.user_id = i.user_id AND e.ts >= a AND e.ts < b GROUP BY iid
""")
def interval_join_by_bins(t: Tables) -> DataFrame:
    """Events within six hours after an error of the same key: an equi-join on (key, bin) instead of comparing all of a key's rows."""
    width = 6 * 3600
    rows = _bars(t)
    spans = rows.filter("event_type = 'error'").select(F.col("event_id").alias("iid"), "user_id", F.col("ts").alias("a"), (F.col("ts") + F.expr("interval 6 hours")).alias("b"))
    bin_of = lambda c: F.floor(F.unix_seconds(c) / width)
    spans = spans.withColumn("bin", F.explode(F.sequence(bin_of(F.col("a")), bin_of(F.col("b")))))
    joined = rows.withColumn("bin", bin_of(F.col("ts"))).join(spans, ["user_id", "bin"]).filter((F.col("ts") >= F.col("a")) & (F.col("ts") < F.col("b")))
    return joined.groupBy("iid").agg(F.count("*").alias("inside"), F.sum("value").alias("total"))


@query("""
WITH p(prefix, price) AS (VALUES ('judge', 1.0), ('judge-a', 2.5)), m AS (SELECT model, count(*) AS n, CAST(sum(length(reasoning)) AS BIGINT) AS chars FROM article_sentiment GROUP BY model),
f AS (SELECT m.model, p.price, row_number() OVER (PARTITION BY m.model ORDER BY length(prefix) DESC) AS k FROM m LEFT JOIN p ON starts_with(m.model, prefix))
SELECT m.model, n, chars, chars * f.price / 1e6 AS cost FROM m JOIN f ON f.model = m.model AND f.k = 1
""")
def longest_prefix_join(t: Tables) -> DataFrame:
    """What each model's answers cost at the price of the longest prefix that fits it; models are counted first, so each meets the prices once."""
    prices = t.spark.createDataFrame([("judge", 1.0), ("judge-a", 2.5)], "prefix string, price double")
    models = t.article_sentiment.groupBy("model").agg(F.count("*").alias("n"), F.sum(F.length("reasoning")).alias("chars"))
    fits = models.join(F.broadcast(prices), F.col("model").startswith(F.col("prefix")), "left")  # two rows
    best = fits.groupBy("model").agg(F.first("n").alias("n"), F.first("chars").alias("chars"), F.max_by("price", F.length("prefix")).alias("price"))
    return best.select("model", "n", "chars", (F.col("chars") * F.col("price") / 1e6).alias("cost"))


@query("""
WITH w AS (SELECT range AS id FROM range(1, (SELECT max(id) + 1001 FROM articles)))
SELECT w.id, a.id IS NULL AS missing, a.status FROM w LEFT JOIN articles a ON a.id = w.id
""")
def missing_ids_restored(t: Tables) -> DataFrame:
    """Every id from 1 to a thousand beyond the largest: those that are not there come out with nulls."""
    wanted = t.articles.agg(F.explode(F.sequence(F.lit(0), F.max("id").cast("bigint") + 1000, F.lit(1 << 16))).alias("a"), F.max("id").alias("m"))
    wanted = wanted.select(F.explode(F.sequence(F.greatest("a", F.lit(1)), F.least(F.col("a") + (1 << 16) - 1, F.col("m") + 1000))).alias("id"))
    found = t.articles.select(F.col("id"), F.lit(True).alias("there"), "status")
    return wanted.join(found, "id", "left").select("id", F.col("there").isNull().alias("missing"), "status")


@query("""
SELECT id, primary_ticker, CAST(CAST(timezone('America/New_York', published_utc) AS DATE) AS VARCHAR) AS day FROM articles
WHERE category IN ('earnings report', 'contract win', 'macro news') AND primary_ticker IS NOT NULL AND CAST(timezone('America/New_York', published_utc) AS DATE) BETWEEN DATE '2024-03-01' AND DATE '2025-09-30'
""")
def category_ticker_date_scan(t: Tables) -> DataFrame:
    """Articles of some categories that have a primary ticker, within a range of the exchange's days."""
    day = market_date(F.col("published_utc"))
    rows = t.articles.filter(F.col("category").isin("earnings report", "contract win", "macro news") & F.col("primary_ticker").isNotNull())
    return rows.filter(day.between(F.to_date(F.lit("2024-03-01")), F.to_date(F.lit("2025-09-30")))).select("id", "primary_ticker", day.cast("string").alias("day"))


@query("""
WITH x AS (SELECT upper(trim(ticker)) AS ticker, CAST(timezone('America/New_York', a.published_utc) AS DATE) AS d FROM article_sentiment s JOIN articles a ON a.id = s.article_id WHERE a.published_utc IS NOT NULL)
SELECT ticker, CAST(min(d) AS VARCHAR) AS first_day, CAST(max(d) AS VARCHAR) AS last_day, count(*) AS n FROM x GROUP BY ticker
""")
def ticker_windows(t: Tables) -> DataFrame:
    """The first and last day of the exchange on which a ticker has a verdict: the window its bars are needed for."""
    days = t.articles.filter(F.col("published_utc").isNotNull()).select(F.col("id").alias("article_id"), market_date(F.col("published_utc")).alias("d"))
    rows = t.article_sentiment.select("article_id", F.upper(stripped(F.col("ticker"))).alias("ticker")).join(days, "article_id")
    return rows.groupBy("ticker").agg(F.min("d").cast("string").alias("first_day"), F.max("d").cast("string").alias("last_day"), F.count("*").alias("n"))


@query("""SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS k FROM orders) WHERE k <= 3""")
def top_per_group(t: Tables) -> DataFrame:
    """The three largest of each key; tasks cut their groups before the shuffle."""
    rank = F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey"))
    return t.orders.withColumn("k", rank).filter("k <= 3").select("o_custkey", "o_orderkey", "o_totalprice")
