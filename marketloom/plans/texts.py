"""Entities, quotes, pages and provider-backed passes. SQL has no form for most of them; tests hold them against literal cases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions import boxes, pages, tagging
from marketloom.plans.registry import Tables, query
from marketloom.providers import HashEmbedder, KeywordClassifier, classified, embedded


@query()
def entity_match(t: Tables) -> DataFrame:
    """Tickers named in each article's title and content, in the order of their first mention."""
    universe = tagging.universe_of(t.ticker_data)
    body = F.concat_ws("\n", F.coalesce("title", F.lit("")), F.coalesce("content", F.lit("")))
    return t.articles.select("id", tagging.mentioned(body, universe).alias("tickers"))


@query()
def annotate_boxes(t: Tables) -> DataFrame:
    """Box texts with each entity's counterpart; lines from QUOTES: on are left as they are."""
    universe = tagging.universe_of(t.ticker_data)
    at = F.locate("QUOTES:", F.col("box_text"))
    head = F.when(at > 0, F.substr("box_text", F.lit(1), at - 1)).otherwise(F.col("box_text"))
    tail = F.when(at > 0, F.substr("box_text", at)).otherwise(F.lit(""))
    return t.article_insights.select("id", F.concat(tagging.annotated(head, universe), tail).alias("box_text"))


@query()
def derived_tags(t: Tables) -> DataFrame:
    return tagging.derived_tags(t.articles, t.ticker_data)


@query("""
WITH x AS (SELECT id, [upper(trim(y)) FOR y IN tickers IF trim(y) <> ''] AS a FROM articles),
s AS (SELECT ticker, segment FROM ticker_data WHERE segment IS NOT NULL),
m AS (SELECT id, p, [more[i] FOR i IN range(1, len(more) + 1) IF list_position(more, more[i]) = i] AS more FROM (SELECT id, a[1] AS p, [y FOR y IN a[2:] IF y <> a[1]] AS more FROM x)),
e AS (SELECT id, p, unnest(more) AS t, unnest(range(1, len(more) + 1)) AS i FROM m),
g AS (SELECT e.id, y.segment, min(i) AS i FROM e JOIN s y ON y.ticker = e.t LEFT JOIN s z ON z.ticker = e.p WHERE y.segment IS DISTINCT FROM z.segment GROUP BY e.id, y.segment)
SELECT m.id, m.p AS primary_ticker, s.segment AS primary_segment, CASE WHEN len(more) > 0 THEN array_to_string(more, ',') END AS more_tickers,
       (SELECT string_agg(segment, ',' ORDER BY i) FROM g WHERE g.id = m.id) AS more_segments
FROM m LEFT JOIN s ON s.ticker = m.p
""")
def derived_tags_of_lists(t: Tables) -> DataFrame:
    """The same from the ticker lists alone, lists in order."""
    d = tagging.derived_tags(t.articles, t.ticker_data, with_text=False)
    return d.select("id", "primary_ticker", "primary_segment", F.array_join("more_tickers", ",").alias("more_tickers"), F.array_join("more_segments", ",").alias("more_segments"))


@query()
def quote_align(t: Tables) -> DataFrame:
    """Each box's quotes as spans of its article's content."""
    source = t.articles.select(F.col("id").alias("article_id"), "content")
    joined = t.article_insights.filter(F.size("quotes") > 0).select("id", "article_id", "quotes").join(source, "article_id")
    aligned = boxes.align_quotes(F.col("quotes"), F.col("content"))
    return joined.select("id", aligned.alias("q")).select("id", "q.quotes", "q.dropped")


@query("""SELECT id, CASE WHEN trim(box_text) <> '' THEN box_text ELSE '' END AS boxes FROM article_insights""")
def box_json_repair(t: Tables) -> DataFrame:
    """Boxes read back from completions made of the box texts: with reasoning before them, in fences, and every other one wrapped in an object that is no JSON."""
    text = F.get_json_object(F.to_json(F.struct("box_text")), "$")
    string = F.regexp_extract(text, r'(?s)^\{"box_text":(.*)\}$', 1)
    box = F.when(F.col("id") % 2 == 0, F.concat(F.lit("{ "), string, F.lit(" }"))).otherwise(string)
    made = F.concat(F.lit('<think>{"boxes": ["no"]}</think>```json\n{"boxes": ['), box, F.lit("]}\n```"))
    return t.article_insights.select("id", F.array_join(boxes.parse_completion(made), "\x01").alias("boxes"))


@query()
def html_extract(t: Tables) -> DataFrame:
    page = pages.page_text(F.col("raw_html"), F.col("source_domain"))
    return t.articles.filter(F.col("raw_html").isNotNull()).select("id", page.alias("p")).select("id", "p.title", "p.text")


@query()
def embedding_pass(t: Tables) -> DataFrame:
    """Vectors of the articles without one, by the offline stand-in."""
    waiting = t.articles.filter(F.col("embedding").isNull())
    return embedded(waiting, HashEmbedder(64), id_col="id", text_col="content").select("id", "embedding")


@query(r"""SELECT id, CASE WHEN regexp_matches(content, '\brevenue\b|\bUmsatz\b', 'i') THEN 'earnings report' WHEN regexp_matches(content, '\bagreed to\b', 'i') THEN 'contract win' ELSE 'other' END AS label FROM articles WHERE category IS NULL AND trim(content, ' ' || chr(10) || chr(9) || chr(13) || chr(160)) <> ''""")
def classification_pass(t: Tables) -> DataFrame:
    rules = KeywordClassifier([("earnings report", r"\brevenue\b|\bUmsatz\b"), ("contract win", r"\bagreed to\b")])
    return classified(t.articles.filter(F.col("category").isNull()), rules, id_col="id", text_col="content")


@query("""SELECT lang, source, count(*) AS documents, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY lang, source""")
def documents_by_language(t: Tables) -> DataFrame:
    return t.documents.groupBy("lang", "source").agg(F.count("*").alias("documents"), F.sum("n_chars").alias("chars"))


@query("""SELECT true AS orders_within, true AS median_within, count(*) AS n FROM lineitem""")
def approximate_distinct(t: Tables) -> DataFrame:
    """Whether the sketches of distinct keys and of the median keep their error bounds (4 standard errors of 1 %, ranks within 1 %) over the whole table."""
    a = t.lineitem.agg(F.approx_count_distinct("l_orderkey", 0.01).alias("about"), F.percentile_approx("l_extendedprice", 0.5, 1000).alias("median"), F.count("*").alias("n"))
    true = t.lineitem.select("l_orderkey").distinct().agg(F.count("*").alias("orders"))
    below = t.lineitem.crossJoin(F.broadcast(a.select("median"))).agg(F.count_if(F.col("l_extendedprice") <= F.col("median")).alias("below"))  # one row
    one = a.crossJoin(F.broadcast(true)).crossJoin(F.broadcast(below))
    return one.select((F.abs(F.col("about") - F.col("orders")) <= 0.04 * F.col("orders")).alias("orders_within"), (F.abs(F.col("below") / F.col("n") - 0.5) <= 0.01).alias("median_within"), "n")
