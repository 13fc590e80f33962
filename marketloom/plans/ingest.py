"""Feed merge, pairs, writes by key, pending work, addresses and text building."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions import text, urls
from marketloom.functions.tagging import universe_of
from marketloom.operators import feed, queue, upsert
from marketloom.plans.registry import Tables, query
from marketloom.semantics import array_or_null, backoff_seconds, blank_to_null, collapsed, feed_time, overlaps, stripped



def _bare(column: str) -> str:
    """SQL for a column without white space at its ends."""
    return rf"regexp_replace({column}, '^[\s\x{{00A0}}]+|[\s\x{{00A0}}]+$', '', 'g')"


_URL, _TICKER, _SENTIMENT, _PUBLISHER = map(_bare, ("article_url", "ticker", "sentiment", "publisher_name"))
_TIME = """epoch_us(coalesce(
  try_strptime(regexp_replace(trim(published_utc), 'Z$', '+00:00'), '%Y-%m-%dT%H:%M:%S%z')::TIMESTAMPTZ,
  timezone('UTC', try_strptime(trim(published_utc), '%Y-%m-%d %H:%M:%S')), timezone('UTC', try_strptime(trim(published_utc), '%Y-%m-%d'))))"""


@query(f"""
WITH c AS (SELECT row_no, {_URL} AS url, upper({_TICKER}) AS symbol, nullif({_SENTIMENT}, '') AS sentiment, {_TIME} AS p, nullif({_PUBLISHER}, '') AS publisher
           FROM news_csv WHERE {_URL} <> ''),
s AS (SELECT url, symbol, min(row_no) AS r, arg_min(struct_pack(v := sentiment), row_no).v AS sentiment FROM c WHERE symbol IS NOT NULL AND symbol <> '' GROUP BY ALL),
a AS (SELECT url, string_agg(symbol, ',' ORDER BY r) AS tickers, string_agg(symbol || '=' || sentiment, ',' ORDER BY r) FILTER (WHERE sentiment IS NOT NULL) AS sentiments FROM s GROUP BY url),
h AS (SELECT url, min(row_no) AS first_row, arg_min(struct_pack(v := p), row_no).v AS published_us, arg_min(struct_pack(v := publisher), row_no).v AS publisher FROM c GROUP BY url)
SELECT h.url, coalesce(tickers, '') AS tickers, published_us, publisher, coalesce(sentiments, '') AS sentiments, first_row FROM h LEFT JOIN a USING (url)
""")
def feed_merge_by_url(t: Tables) -> DataFrame:
    """One article per address: tickers as first seen, date and publisher of the first row, sentiments of the tickers' first rows."""
    m = feed.merged_articles(t.news_csv)
    return m.select("url", F.array_join("tickers", ",").alias("tickers"), F.unix_micros("published_utc").alias("published_us"), "publisher", F.coalesce(F.array_join(F.transform(F.map_entries("sentiments"), lambda x: F.concat(x["key"], F.lit("="), x["value"]["sentiment"])), ","), F.lit("")).alias("sentiments"), "first_row")


@query(f"""
SELECT url, first_row FROM (SELECT {_URL} AS url, min(row_no) AS first_row FROM news_csv WHERE {_URL} <> '' GROUP BY 1) ORDER BY first_row LIMIT 50
""")
def feed_first_articles(t: Tables) -> DataFrame:
    """The first 50 articles (not rows) of the feed: the limit is the feature."""
    return feed.merged_articles(t.news_csv).select("url", "first_row").orderBy("first_row").limit(50)


@query(f"""SELECT upper({_TICKER}) AS symbol, {_URL} AS url, min(row_no) AS row_no, count(*) AS rows FROM news_csv WHERE {_TICKER} <> '' AND {_URL} <> '' GROUP BY 1, 2""")
def feed_distinct_pairs(t: Tables) -> DataFrame:
    return feed.distinct_pairs(t.news_csv)


@query(f"""SELECT upper({_TICKER}) AS symbol, max(p) AS newest_us, count(*) AS rows FROM (SELECT ticker, {_TIME} AS p FROM news_csv) GROUP BY 1""")
def feed_cursor_per_ticker(t: Tables) -> DataFrame:
    return feed.cursors(t.news_csv).select("symbol", F.unix_micros("newest").alias("newest_us"), "rows")


@query(f"""SELECT row_no, {_TIME} AS us FROM news_csv""")
def feed_time_parse(t: Tables) -> DataFrame:
    """Dates in several spellings; null where there is none."""
    return t.news_csv.select("row_no", F.unix_micros(feed_time(F.col("published_utc"))).alias("us"))


@query(f"""SELECT lower({_SENTIMENT}) AS sentiment, count(*) AS rows, count(DISTINCT upper({_TICKER})) AS tickers FROM news_csv WHERE {_SENTIMENT} <> '' GROUP BY 1""")
def feed_sentiment_counts(t: Tables) -> DataFrame:
    rows = t.news_csv.filter(stripped(F.col("sentiment")) != "")
    return rows.groupBy(F.lower(stripped(F.col("sentiment"))).alias("sentiment")).agg(F.count("*").alias("rows"), F.countDistinct(F.upper(stripped(F.col("ticker")))).alias("tickers"))


@query("""
WITH d AS (SELECT article_url AS url, max(publisher) AS publisher FROM pipeline_jobs GROUP BY 1)
SELECT coalesce(a.url, d.url) AS url, coalesce(d.publisher, a.publisher) AS publisher, a.title, a.id IS NULL AS is_new
FROM articles a FULL JOIN d ON a.url = d.url
""")
def upsert_latest_wins(t: Tables) -> DataFrame:
    """Articles with the publisher of the queue's rows; addresses not yet there are added, other columns are kept."""
    base = t.articles.select("url", "publisher", "title", F.lit(False).alias("is_new"))
    delta = t.pipeline_jobs.groupBy(F.col("article_url").alias("url")).agg(F.max("publisher").alias("publisher"))
    delta = delta.join(base.select("url", F.col("publisher").alias("_old")), "url", "left").select("url", F.coalesce("publisher", "_old").alias("publisher"), F.lit(None).cast("string").alias("title"), F.lit(True).alias("is_new"))
    return upsert.upsert(base, delta, ["url"], keep=("title", "is_new"))


@query("""SELECT url, title IS NOT NULL AS scraped FROM articles UNION ALL SELECT article_url, false FROM pipeline_jobs ANTI JOIN articles ON article_url = url""")
def insert_if_absent(t: Tables) -> DataFrame:
    base = t.articles.select("url", F.col("title").isNotNull().alias("scraped"))
    return upsert.insert_absent(base, t.pipeline_jobs.select(F.col("article_url").alias("url"), F.lit(False).alias("scraped")), ["url"])


@query("""SELECT a.id, coalesce(a.publisher, j.publisher) AS publisher FROM articles a LEFT JOIN (SELECT article_url, max(publisher) AS publisher FROM pipeline_jobs GROUP BY 1) j ON j.article_url = a.url""")
def set_if_null(t: Tables) -> DataFrame:
    delta = t.pipeline_jobs.groupBy(F.col("article_url").alias("url")).agg(F.max("publisher").alias("publisher"))
    return upsert.set_if_null(t.articles.select("id", "url", "publisher"), delta, ["url"], "publisher").select("id", "publisher")


@query("""SELECT id, CASE WHEN status = 'ok' THEN category END AS category, CASE WHEN status = 'ok' THEN primary_ticker END AS primary_ticker, status FROM articles""")
def reset_columns(t: Tables) -> DataFrame:
    return upsert.reset(t.articles.select("id", "category", "primary_ticker", "status"), ["category", "primary_ticker"], F.col("status") != "ok")


@query("""SELECT i.id, i.topic, i.article_id IN (SELECT id FROM articles WHERE status = 'ok') AS replaced, CASE WHEN i.article_id IN (SELECT id FROM articles WHERE status = 'ok') THEN NULL ELSE len(i.embedding) END AS size FROM article_insights i""")
def upsert_boxes_null_vector(t: Tables) -> DataFrame:
    """Boxes written again lose their vector."""
    base = t.article_insights.select("article_id", "box_index", "id", "topic", F.size("embedding").alias("size"), F.lit(False).alias("replaced"))
    base = base.withColumn("size", F.when(F.col("size") >= 0, F.col("size")))
    again = base.join(t.articles.filter("status = 'ok'").select(F.col("id").alias("article_id")), "article_id", "left_semi").withColumn("replaced", F.lit(True))
    return upsert.upsert(base, again, ["article_id", "box_index"], null_on_update=("size",)).select("id", "topic", "replaced", "size")


@query("""SELECT article_id, ticker, action FROM article_sentiment WHERE article_id NOT IN (SELECT id FROM articles WHERE status <> 'ok')""")
def delete_by_key(t: Tables) -> DataFrame:
    gone = t.articles.filter("status <> 'ok'").select(F.col("id").alias("article_id"))
    return upsert.delete(t.article_sentiment.select("article_id", "ticker", "action"), gone, ["article_id"])


@query("""SELECT id FROM articles WHERE trim(coalesce(content, '')) <> '' AND category IS NULL""")
def pending_classification(t: Tables) -> DataFrame:
    return t.articles.filter(blank_to_null(F.col("content")).isNotNull() & F.col("category").isNull()).select("id")


@query("""SELECT a.id FROM articles a WHERE insights_extracted_at IS NULL AND NOT EXISTS (SELECT 1 FROM article_insights i WHERE i.article_id = a.id)""")
def pending_anti_join(t: Tables) -> DataFrame:
    """Articles without boxes."""
    waiting = t.articles.filter(F.col("insights_extracted_at").isNull()).select("id")
    return upsert.pending(waiting, t.article_insights.select(F.col("article_id").alias("id")), ["id"])


@query("""SELECT id, url FROM articles a WHERE EXISTS (SELECT 1 FROM article_sentiment s WHERE s.article_id = a.id)""")
def exists_semi_join(t: Tables) -> DataFrame:
    return t.articles.select("id", "url").join(t.article_sentiment.select(F.col("article_id").alias("id")), "id", "left_semi")


@query("""SELECT id, url FROM articles WHERE url = (SELECT min(url_canonical) FROM articles) OR url_canonical = (SELECT min(url_canonical) FROM articles)""")
def point_lookup(t: Tables) -> DataFrame:
    wanted = t.articles.agg(F.min("url_canonical").alias("w"))
    return t.articles.select("id", "url", "url_canonical").join(F.broadcast(wanted), (F.col("url") == F.col("w")) | (F.col("url_canonical") == F.col("w"))).select("id", "url")


@query("""SELECT status, stage, count(*) AS jobs, max(attempts) AS most FROM pipeline_jobs GROUP BY status, stage""")
def queue_counts(t: Tables) -> DataFrame:
    return t.pipeline_jobs.groupBy("status", "stage").agg(F.count("*").alias("jobs"), F.max("attempts").alias("most"))


@query("""SELECT article_url, epoch_us(enqueued_at) AS us FROM pipeline_jobs WHERE status = 'pending' ORDER BY enqueued_at, article_url LIMIT 20""")
def claim_fifo(t: Tables) -> DataFrame:
    """The next 20 jobs: the limit is the feature."""
    return t.pipeline_jobs.filter("status = 'pending'").orderBy("enqueued_at", "article_url").limit(20).select("article_url", F.unix_micros("enqueued_at").alias("us"))


@query("""SELECT article_url, attempts, CAST(least(30 * pow(2, attempts), 3600) AS BIGINT) AS seconds FROM pipeline_jobs WHERE status <> 'done'""")
def backoff_schedule(t: Tables) -> DataFrame:
    return t.pipeline_jobs.filter("status <> 'done'").select("article_url", "attempts", backoff_seconds(F.col("attempts")).alias("seconds"))


_NOW = "2026-01-01 00:00:00"


@query(f"""
WITH f AS (SELECT *, attempts + 1 AS tries, stage = 'scrape' AND attempts >= 2 AS gone FROM pipeline_jobs WHERE status = 'running')
SELECT j.article_url, CASE WHEN f.article_url IS NULL THEN j.status WHEN gone OR tries >= 5 THEN 'failed' ELSE 'pending' END AS status, coalesce(tries, j.attempts) AS attempts,
  epoch_us(CASE WHEN f.article_url IS NOT NULL AND NOT (gone OR tries >= 5) THEN timezone('UTC', TIMESTAMP '{_NOW}') + CAST(least(30 * pow(2, tries - 1), 3600) AS BIGINT) * INTERVAL 1 SECOND ELSE j.next_attempt_at END) AS next_us
FROM pipeline_jobs j LEFT JOIN f USING (article_url)
""")
def queue_after_failures(t: Tables) -> DataFrame:
    """The queue after every running job has failed once more, some of them for good."""
    failures = t.pipeline_jobs.filter("status = 'running'").select("article_url", F.lit("timeout").alias("error"), ((F.col("stage") == "scrape") & (F.col("attempts") >= 2)).alias("permanent"))
    after = queue.after_failures(t.pipeline_jobs, failures, F.to_timestamp(F.lit(_NOW)))
    return after.select("article_url", "status", "attempts", F.unix_micros("next_attempt_at").alias("next_us"))


@query(f"""SELECT article_url, CASE WHEN status IN ('running', 'failed') THEN 'pending' ELSE status END AS status, CASE WHEN status = 'failed' THEN 0 ELSE attempts END AS attempts,
  epoch_us(CASE WHEN status = 'failed' THEN timezone('UTC', TIMESTAMP '{_NOW}') ELSE next_attempt_at END) AS next_us FROM pipeline_jobs""")
def queue_recovered(t: Tables) -> DataFrame:
    """The queue after a restart: orphans pending again, failed jobs tried anew."""
    again = queue.requeued(queue.recovered(t.pipeline_jobs), F.to_timestamp(F.lit(_NOW)))
    return again.select("article_url", "status", "attempts", F.unix_micros("next_attempt_at").alias("next_us"))


@query("""SELECT article_url, json_extract_string(source_meta, '$.provider') AS provider, CAST(json_extract_string(source_meta, '$.seq') AS BIGINT) AS seq FROM pipeline_jobs""")
def json_meta_extract(t: Tables) -> DataFrame:
    meta = F.from_json("source_meta", "provider string, seq bigint")
    return t.pipeline_jobs.select("article_url", meta["provider"].alias("provider"), meta["seq"].alias("seq"))


@query(r"""SELECT id, regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1)), '^www\.', '') AS domain FROM articles""")
def url_domain(t: Tables) -> DataFrame:
    return t.articles.select("id", urls.domain_of(F.col("url")).alias("domain"))


@query(r"""
WITH p AS (SELECT id, regexp_extract(url, '^([^?#]*)', 1) AS head, regexp_extract(url, '^[^?#]*\?([^#]*)', 1) AS rest FROM articles),
o AS (SELECT *, regexp_extract(head, '^([A-Za-z][A-Za-z0-9+.\-]*://[^/]*)', 1) AS origin FROM p),
q AS (SELECT id, origin, regexp_replace(substr(head, length(origin) + 1), '/+$', '') AS path,
             array_to_string([f FOR f IN string_split(rest, '&') IF regexp_matches(f, '^[^=]+=.') AND NOT starts_with(lower(split_part(f, '=', 1)), 'utm_')
                              AND lower(split_part(f, '=', 1)) NOT IN ('source', 'ref', 'fbclid', 'gclid', 'mc_cid', 'mc_eid', 'yptr')], '&') AS query FROM o)
SELECT id, concat(lower(origin), CASE WHEN path = '' THEN '/' ELSE path END, CASE WHEN query <> '' THEN '?' || query ELSE '' END) AS canonical FROM q
""")
def url_canonical(t: Tables) -> DataFrame:
    return t.articles.select("id", urls.canonical_url(F.col("url")).alias("canonical"))


@query(r"""SELECT id, md5(substr(concat_ws(chr(10) || chr(10), nullif(trim(title), ''), nullif(trim(content), '')), 1, 64000)) AS digest FROM articles""")
def embed_text_build(t: Tables) -> DataFrame:
    return t.articles.select("id", F.md5(text.embedding_text(F.col("title"), F.col("content"))).alias("digest"))


@query(r"""
WITH w AS (SELECT id, trim(regexp_replace(coalesce(content, ''), '[\s\x{00A0}]+', ' ', 'g')) AS c FROM articles)
SELECT id, CASE WHEN c = '' THEN 0 ELSE len(string_split(c, ' ')) END AS words, CASE WHEN c = '' THEN 0 ELSE len(string_split(c, ' ')) END < 120 AS weak FROM w
""")
def word_count_weak(t: Tables) -> DataFrame:
    return t.articles.select("id", text.word_count(F.col("content")).alias("words"), text.is_weak(F.col("content")).alias("weak"))


@query("""
SELECT id, coalesce(http_status IN (401, 403, 404, 429) OR http_status >= 500, true) OR coalesce(length(raw_html) < 800, true)
  OR coalesce(contains(substr(raw_html, 1, 2000), 'Just a moment') OR contains(substr(raw_html, 1, 2000), 'cf-browser-verification') OR contains(substr(raw_html, 1, 2000), 'Checking your browser')
     OR contains(substr(raw_html, 1, 2000), 'Attention Required') OR contains(substr(raw_html, 1, 2000), 'Enable JavaScript and cookies to continue'), false) AS bad FROM articles
""")
def bad_page_predicate(t: Tables) -> DataFrame:
    return t.articles.select("id", text.looks_bad(F.col("http_status"), F.col("raw_html")).alias("bad"))


@query(r"""SELECT id, trim(regexp_replace(coalesce(nullif(insight, ''), topic, ''), '[\s\x{00A0}]+', ' ', 'g')) AS excerpt FROM article_insights""")
def whitespace_collapse(t: Tables) -> DataFrame:
    return t.article_insights.select("id", text.excerpt(F.col("insight"), F.col("topic")).alias("excerpt"))


@query(r"""SELECT id, md5(CASE WHEN starts_with(box_text, 'ARTICLE_HEADLINE:') THEN box_text ELSE 'ARTICLE_HEADLINE: ' || trim(coalesce(article_headline, '')) || chr(10) || box_text END) AS digest FROM article_insights""")
def box_with_headline(t: Tables) -> DataFrame:
    return t.article_insights.select("id", F.md5(text.with_headline(F.col("box_text"), F.col("article_headline"))).alias("digest"))


@query(r"""
WITH l AS (SELECT id, string_split(box_text, chr(10)) AS x FROM article_insights),
p AS (SELECT id, x, list_position([starts_with(y, 'QUOTES:') FOR y IN x], true) AS pos FROM l)
SELECT id, (SELECT trim(substr(y, 7)) FROM (SELECT unnest(x) AS y) WHERE starts_with(y, 'TOPIC:') LIMIT 1) AS topic,
       (SELECT trim(substr(y, 9)) FROM (SELECT unnest(x) AS y) WHERE starts_with(y, 'INSIGHT:') LIMIT 1) AS insight,
       CASE WHEN pos IS NULL OR pos = 0 THEN '' ELSE array_to_string([rtrim(y) FOR y IN x[pos + 1:] IF trim(y) <> ''], chr(10)) END AS quotes FROM p
""")
def box_parse(t: Tables) -> DataFrame:
    parts = text.box_parts(F.col("box_text"))
    return t.article_insights.select("id", parts["topic"].alias("topic"), parts["insight"].alias("insight"), F.array_join(parts["quotes"], "\n").alias("quotes"))


@query("""SELECT id, list_distinct([upper(trim(x)) FOR x IN tickers IF trim(x) <> '']) IS NOT NULL AND list_has_any([upper(trim(x)) FOR x IN tickers IF x IS NOT NULL], (SELECT list(ticker) FROM ticker_data WHERE segment = 'Cloud')) AS hit FROM articles WHERE tickers IS NOT NULL""")
def array_overlap_filter(t: Tables) -> DataFrame:
    """Articles whose tickers share one with a segment's."""
    wanted = [ticker for ticker, _, segment in universe_of(t.ticker_data) if segment == "Cloud"]  # refuses to grow beyond a dimension
    clean = F.transform("tickers", lambda x: F.upper(stripped(x)))
    return t.articles.filter(F.col("tickers").isNotNull()).select("id", overlaps(clean, wanted).alias("hit"))


@query("""
WITH x AS (SELECT id, [upper(trim(y)) FOR y IN tickers IF trim(y) <> ''] AS a FROM articles),
d AS (SELECT id, a[1] AS primary_ticker, [y FOR y IN a[2:] IF y <> a[1]] AS more FROM x)
SELECT id, primary_ticker, CASE WHEN len(more) > 0 THEN array_to_string([more[i] FOR i IN range(1, len(more) + 1) IF list_position(more, more[i]) = i], ',') END AS more FROM d
""")
def derive_tags_from_array(t: Tables) -> DataFrame:
    a = F.filter(F.transform("tickers", lambda x: F.upper(stripped(x))), lambda x: x.isNotNull() & (x != ""))
    rows = t.articles.select("id", a.alias("a")).withColumn("primary_ticker", F.get("a", F.lit(0)))
    more = array_or_null(F.array_distinct(F.filter(F.slice("a", F.lit(2), F.greatest(F.size("a"), F.lit(1))), lambda x: x != F.col("primary_ticker"))))
    return rows.select("id", "primary_ticker", F.array_join(more, ",").alias("more"))


@query("""SELECT id, k AS ticker, v.sentiment AS sentiment FROM (SELECT id, unnest(map_keys(provider_sentiments)) AS k, unnest(map_values(provider_sentiments)) AS v FROM articles)""")
def map_explode(t: Tables) -> DataFrame:
    return t.articles.select("id", F.explode("provider_sentiments").alias("ticker", "v")).select("id", "ticker", "v.sentiment")


@query("""
WITH x AS (SELECT id, primary_ticker, primary_segment, coalesce(len(more_tickers), 0) AS more FROM articles),
m AS (SELECT DISTINCT upper(trim(p)) AS p FROM (SELECT primary_ticker AS p FROM articles UNION ALL SELECT unnest(more_tickers) FROM articles) WHERE trim(p) <> '')
SELECT count(*) AS articles, count(*) FILTER (WHERE primary_ticker IS NOT NULL) AS tagged, count(*) FILTER (WHERE primary_segment IS NOT NULL) AS with_segment, count(*) FILTER (WHERE more > 0) AS with_more,
  (SELECT count(*) FROM m WHERE p NOT IN (SELECT upper(trim(ticker)) FROM ticker_data)) AS unmatched_tickers FROM x
""")
def tag_run_counters(t: Tables) -> DataFrame:
    """What a tagging run reached: articles tagged, with a segment, with more tickers, and tickers the universe lacks."""
    more = F.coalesce(F.size("more_tickers"), F.lit(0)) > 0
    counts = t.articles.agg(F.count("*").alias("articles"), F.count("primary_ticker").alias("tagged"), F.count("primary_segment").alias("with_segment"), F.count_if(more).alias("with_more"))
    named = t.articles.select(F.explode(F.concat(F.array("primary_ticker"), F.coalesce("more_tickers", F.array().cast("array<string>")))).alias("p")).select(F.upper(stripped(F.col("p"))).alias("p")).filter("p <> ''").distinct()
    unmatched = named.join(t.ticker_data.select(F.upper(stripped(F.col("ticker"))).alias("p")), "p", "left_anti").agg(F.count("*").alias("unmatched_tickers"))
    return counts.crossJoin(F.broadcast(unmatched))  # one row


@query("""SELECT count(*) AS wanted, count(*) FILTER (WHERE id IS NULL) AS missing, count(*) FILTER (WHERE id IS NOT NULL AND coalesce(status <> 'ok', true)) AS not_ok,
  count(*) FILTER (WHERE id IS NOT NULL AND trim(coalesce(content, '')) = '') AS without_content, count(*) FILTER (WHERE id IS NOT NULL AND published_utc IS NULL) AS without_date,
  count(*) FILTER (WHERE status = 'ok' AND trim(coalesce(content, '')) <> '' AND published_utc IS NOT NULL) AS usable
  FROM (SELECT DISTINCT article_id FROM article_sentiment) s LEFT JOIN articles a ON a.id = s.article_id""")
def evaluation_ready(t: Tables) -> DataFrame:
    """How many of the articles to be evaluated are there, ok, with content and date; `checked_ready` makes an error of it."""
    return upsert.readiness(t.article_sentiment.select("article_id").distinct(), t.articles)


@query(r"""SELECT id, md5(CASE WHEN coalesce(trim(content), '') = '' THEN ' ' WHEN length(content) <= 800 THEN content ELSE array_to_string(regexp_extract_all(content, '[ \t\n\r\f]*[^ \t\n\r\f]+')[1:120], '') END) AS digest FROM articles""")
def token_cut(t: Tables) -> DataFrame:
    """Contents cut to 120 tokens of a tokenizer behind an interface (here words); short ones pass, blank ones become one blank."""
    return t.articles.select("id", F.md5(text.cut_to_tokens(F.col("content"), 120, passing=800)).alias("digest"))


@query("""SELECT publisher, count(*) AS articles, count(DISTINCT source_domain) AS domains FROM articles GROUP BY 1""")
def publisher_counts(t: Tables) -> DataFrame:
    return t.articles.groupBy("publisher").agg(F.count("*").alias("articles"), F.countDistinct("source_domain").alias("domains"))


@query(r"""SELECT id, trim(regexp_replace(title, '[\s\x{00A0}]+', ' ', 'g')) AS title FROM articles WHERE title IS NOT NULL""")
def clean_titles(t: Tables) -> DataFrame:
    return t.articles.filter(F.col("title").isNotNull()).select("id", collapsed(F.col("title")).alias("title"))
