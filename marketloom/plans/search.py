"""Vector searches over articles and insight boxes. Query rows of the joins are those whose id is divisible by 50."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions import text
from marketloom.functions.vectors import nearest
from marketloom.operators import precedents, retrieval
from marketloom.operators.filters import SearchFilter, scoped
from marketloom.plans.registry import Tables, query
from marketloom.providers import HashEmbedder
from marketloom.semantics import months_before

_USABLE = "embedding IS NOT NULL AND len(embedding) > 0 AND list_max([abs(x) FOR x IN embedding]) > 0"
_A = f"a AS (SELECT *, embedding::DOUBLE[] AS e, epoch_us(published_utc) AS us FROM articles WHERE {_USABLE})"
_B = f"b AS (SELECT i.id, i.article_id, i.box_index, i.topic, i.insight, i.embedding::DOUBLE[] AS e, epoch_us(x.published_utc) AS us FROM article_insights i JOIN articles x ON x.id = i.article_id WHERE i.{_USABLE.replace('len(embedding)', 'len(i.embedding)').replace('IN embedding', 'IN i.embedding')} AND x.published_utc IS NOT NULL)"
_SEED = "s AS (SELECT id AS sid, e AS se, us AS sus, published_utc AS sp, primary_segment AS sseg FROM a WHERE published_utc IS NOT NULL ORDER BY id LIMIT 1)"
_COS = "round(list_cosine_similarity(a.e, s.se), 9)"


def _seed(t: Tables) -> tuple[int, list[float]]:
    found = retrieval.seed_vector(t.articles, F.col("published_utc").isNotNull())
    return found if found else (-1, [1.0])


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("similarity", F.round("similarity", 6))


@query(f"WITH {_A}, {_SEED} SELECT a.id, round({_COS}, 6) AS similarity FROM a, s WHERE a.id <> sid ORDER BY {_COS} DESC, a.id LIMIT 10")
def more_like_this(t: Tables) -> DataFrame:
    """The 10 articles most similar to one article."""
    seed, vector = _seed(t)
    return _rounded(retrieval.similar_articles(t.articles, vector, k=10, where=SearchFilter(exclude_id=seed)))


@query(f"""WITH {_A}, {_SEED}, h AS (SELECT a.id, {_COS} AS similarity FROM a, s WHERE a.id <> sid AND a.source_domain = 'marketwren.example' AND a.published_utc >= TIMESTAMPTZ '2024-06-01 00:00:00+00' AND a.published_utc < TIMESTAMPTZ '2026-01-01 00:00:00+00'
  ORDER BY similarity DESC, a.id LIMIT 20) SELECT id, round(similarity, 6) AS similarity FROM h WHERE similarity >= 0.1""")
def vector_search_filtered(t: Tables) -> DataFrame:
    """Filters before similarity, the floor after the limit."""
    seed, vector = _seed(t)
    where = SearchFilter(domain="marketwren.example", since="2024-06-01", until="2025-12-31", exclude_id=seed)
    return _rounded(retrieval.similar_articles(t.articles, vector, k=20, where=where, floor=0.1))


@query(f"""WITH {_A}, {_SEED} SELECT a.id, round({_COS}, 6) AS similarity FROM a, s WHERE a.id <> sid AND a.published_utc < sp AND a.published_utc >= timezone('UTC', timezone('UTC', sp) - INTERVAL 6 MONTH) ORDER BY {_COS} DESC, a.id LIMIT 10""")
def seed_window_search(t: Tables) -> DataFrame:
    """Articles of the six calendar months before the seed."""
    seed, vector = _seed(t)
    when = t.articles.filter(F.col("id") == seed).select(F.col("published_utc").alias("until"), months_before(F.col("published_utc"), 6).alias("since"))
    rows = t.articles.join(F.broadcast(when), (F.col("published_utc") < F.col("until")) & (F.col("published_utc") >= F.col("since"))).drop("until", "since")
    return _rounded(retrieval.similar_articles(rows, vector, k=10, where=SearchFilter(exclude_id=seed)))


@query(f"""WITH {_A}, {_SEED}, h AS (SELECT seg, a.id, {_COS} AS similarity, row_number() OVER (PARTITION BY seg ORDER BY {_COS} DESC, a.id) AS r
  FROM a, s, (SELECT DISTINCT segment AS seg FROM ticker_data WHERE segment IS NOT NULL) WHERE coalesce(primary_segment = seg, false) OR coalesce(list_contains(more_segments, seg), false))
  SELECT seg AS segment, id, round(similarity, 6) AS similarity FROM h WHERE r <= 3""")
def scoped_search(t: Tables) -> DataFrame:
    """One query against every segment: the top 3 of each."""
    _, vector = _seed(t)
    rows = retrieval.usable(t.articles)
    segments = F.array_distinct(F.array_compact(F.concat(F.array("primary_segment"), F.coalesce("more_segments", F.array().cast("array<string>")))))
    scored = rows.select("id", retrieval.cosine_to(F.col("embedding"), vector).alias("similarity"), segments.alias("s")).select("id", "similarity", F.explode("s").alias("segment"))
    scored = scored.join(F.broadcast(t.ticker_data.select("segment").distinct()), "segment", "left_semi")
    rank = F.row_number().over(Window.partitionBy("segment").orderBy(F.desc("similarity"), "id"))
    return _rounded(scored.withColumn("r", rank).filter("r <= 3").select("segment", "id", "similarity"))


_TEXT = "wafer makers blamed export limits for a weak quarter"
_EMBEDDER = HashEmbedder(64)


def _vector(text: str) -> list[float]:
    return [float(x) for x in _EMBEDDER.embed([text])[0]]


def _literal(text: str) -> str:
    return "[" + ", ".join(repr(x) for x in _vector(text)) + "]::DOUBLE[]"


def _to(text: str, column: str = "a.e") -> str:
    return f"round(list_cosine_similarity({column}, {_literal(text)}), 9)"


@query(f"""WITH {_A}, h AS (SELECT a.id, {_to(_TEXT)} AS similarity FROM a WHERE coalesce(primary_segment = 'Cloud', false) OR coalesce(list_contains(more_segments, 'Cloud'), false) ORDER BY similarity DESC, a.id LIMIT 15)
SELECT id, round(similarity, 6) AS similarity FROM h WHERE similarity >= 0.0""")
def text_search(t: Tables) -> DataFrame:
    """A text is embedded, the filter narrows the articles, then the top 15, then the floor."""
    return _rounded(retrieval.similar_articles(t.articles, _vector(_TEXT), k=15, where=SearchFilter(segment="Cloud"), floor=0.0))


@query(f"""WITH {_A}, s AS (SELECT id AS sid, e AS se FROM a WHERE url = (SELECT max(url) FROM a) ORDER BY id LIMIT 1)
SELECT a.id, round({_COS}, 6) AS similarity FROM a, s WHERE a.id <> sid ORDER BY {_COS} DESC, a.id LIMIT 10""")
def more_like_url(t: Tables) -> DataFrame:
    """The 10 articles most similar to the one with an address."""
    url = retrieval.usable(t.articles).agg(F.max("url")).first()[0]
    seed, vector = retrieval.seed_vector(t.articles, F.col("url") == F.lit(url)) or (-1, [1.0])
    return _rounded(retrieval.similar_articles(t.articles, vector, k=10, where=SearchFilter(exclude_id=seed)))


_STATEMENTS = (("chip orders rise", "sector", None), ("a bank cuts its dividend", "segment", "Cloud"), ("new data centers are delayed", "ticker", "NVDA"))


def _in_scope(scope: str, value: str | None) -> str:
    if scope == "ticker":
        return f"list_has_any([x FOR x IN coalesce(tickers, []) IF x IS NOT NULL], ['{value}'])"
    return "true" if scope == "sector" else f"(coalesce(primary_segment = '{value}', false) OR coalesce(list_contains(more_segments, '{value}'), false))"


@query(f"WITH {_A} " + " UNION ALL ".join(f"(SELECT '{x}' AS statement, id, round({_to(x)}, 6) AS similarity FROM a WHERE {_in_scope(scope, value)} ORDER BY {_to(x)} DESC, id LIMIT 8)" for x, scope, value in _STATEMENTS))
def statement_batch(t: Tables) -> DataFrame:
    """Statements, each searched within its own scope: the whole sector, a segment or a ticker."""
    parts = [retrieval.similar_articles(t.articles, _vector(x), k=8, where=scoped(scope, value)).select(F.lit(x).alias("statement"), "id", "similarity") for x, scope, value in _STATEMENTS]
    return _rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query(f"""WITH {_B}, h AS (SELECT b.id, b.article_id, {_to(_TEXT, "b.e")} AS similarity FROM b JOIN articles x ON x.id = b.article_id
  WHERE x.source_domain = 'marketwren.example' AND x.published_utc >= TIMESTAMPTZ '2024-03-01 00:00:00+00' AND x.published_utc < TIMESTAMPTZ '2026-01-01 00:00:00+00' ORDER BY similarity DESC, b.id LIMIT 25)
SELECT id, article_id, round(similarity, 6) AS similarity FROM h WHERE similarity >= -0.2""")
def box_text_search(t: Tables) -> DataFrame:
    """Boxes most like a text, narrowed by conditions on their articles before any similarity."""
    where = SearchFilter(domain="marketwren.example", since="2024-03-01", until="2025-12-31").column("a_")
    a = t.articles.filter(F.col("published_utc").isNotNull()).select(*[F.col(c).alias("a_" + c) for c in ("id", "source_domain", "published_utc")]).filter(where)
    boxes = retrieval.usable(t.article_insights).select("id", "article_id", "embedding").join(a.select(F.col("a_id").alias("article_id")), "article_id")
    scored = boxes.select("id", "article_id", retrieval.cosine_to(F.col("embedding"), _vector(_TEXT)).alias("similarity"))
    return _rounded(scored.orderBy(F.desc("similarity"), "id").limit(25).filter("similarity >= -0.2"))


def _boxes(t: Tables) -> DataFrame:
    when = t.articles.filter(F.col("published_utc").isNotNull()).select(F.col("id").alias("article_id"), F.unix_micros("published_utc").alias("us"))
    boxes = retrieval.usable(t.article_insights).select("id", F.col("embedding").alias("vector"), "article_id")
    return boxes.join(when, "article_id").select("id", "vector", "article_id", "us")


def _seeds(t: Tables) -> DataFrame:
    return _boxes(t).filter("id % 50 = 0").withColumnRenamed("id", "seed_id")


_S = "s AS (SELECT id AS seed_id, article_id AS sart, e AS se, us AS sus FROM b WHERE id % 50 = 0)"
_HITS = f"""{_B}, {_S}, h AS (SELECT seed_id, sart, b.id, b.article_id, round(list_cosine_similarity(b.e, se), 9) AS similarity, row_number() OVER (PARTITION BY seed_id ORDER BY round(list_cosine_similarity(b.e, se), 9) DESC, b.id) AS r
  FROM b, s WHERE b.article_id <> sart AND b.us < sus)"""


@query(f"WITH {_HITS} SELECT seed_id, id, round(similarity, 6) AS similarity, CAST(r AS INTEGER) AS rank FROM h WHERE r <= 5 AND similarity > 0.3")
def knn_join_topk(t: Tables) -> DataFrame:
    """Each seed box's five most similar boxes of other, earlier articles."""
    return _rounded(retrieval.box_hits(_seeds(t), _boxes(t), k=5, floor=0.3))


_GROUPS = f"{_HITS}, g AS (SELECT sart, article_id, max(m) AS best, count(*) AS matches, sum(m) AS total FROM (SELECT sart, seed_id, article_id, max(similarity) AS m FROM h WHERE r <= 20 AND similarity > 0.2 GROUP BY ALL) GROUP BY sart, article_id)"


@query(f"WITH {_GROUPS} SELECT sart AS seed_article, article_id, round(best, 6) AS best, matches, round(total, 6) AS total FROM (SELECT *, row_number() OVER (PARTITION BY sart ORDER BY best DESC, matches DESC, total DESC, article_id) AS k FROM g) WHERE k <= 5")
def related_consolidated(t: Tables) -> DataFrame:
    """Articles related through their boxes: best hit, matching seeds and total."""
    boxes, seeds = _boxes(t), _seeds(t)
    hits = retrieval.box_hits(seeds, boxes, k=20, floor=0.2)
    hits = hits.join(boxes.select("id", "article_id"), "id").join(seeds.select("seed_id", F.col("article_id").alias("seed_article")), "seed_id")
    top = retrieval.ranked(retrieval.consolidated(hits, ["seed_article"]), ["seed_article"], 5)
    return top.select("seed_article", "article_id", F.round("best", 6).alias("best"), "matches", F.round("total", 6).alias("total"))


@query(f"""WITH {_A}, s AS (SELECT id AS sid, e AS se, us AS sus FROM a WHERE id % 50 = 0 AND us IS NOT NULL),
h AS (SELECT sid, a.id, {_COS} AS similarity, row_number() OVER (PARTITION BY sid ORDER BY {_COS} DESC, a.id) AS r FROM a, s WHERE a.id <> sid AND a.us < sus AND a.us >= sus - 90 * 86400000000)
SELECT sid AS seed_id, id, round(similarity, 6) AS similarity FROM h WHERE r <= 5""")
def precedents_article(t: Tables) -> DataFrame:
    """Each query article's five most similar ones of the 90 days before it."""
    rows = retrieval.usable(t.articles).filter(F.col("published_utc").isNotNull()).select("id", F.col("embedding").alias("vector"), F.unix_micros("published_utc").alias("us"))
    seeds = rows.filter("id % 50 = 0").select(F.col("id").alias("seed_id"), "vector", "us")
    return _rounded(nearest(seeds, rows, 5, keep=lambda s, c: (c["us"] < s["us"]) & (c["us"] >= s["us"] - 7_776_000_000_000)).select("seed_id", "id", "similarity"))


@query(f"""WITH {_A}, {_B}, q AS (SELECT id AS sid, e AS se, us AS sus FROM a WHERE id % 50 = 0 AND us IS NOT NULL),
n AS (SELECT sid, a.id FROM a, q WHERE a.id <> sid AND a.us < sus AND round(list_cosine_similarity(a.e, se), 9) > 0.3),
x AS (SELECT q.sid, b2.id AS seed_id, b2.e AS se FROM q JOIN b b2 ON b2.article_id = q.sid)
SELECT x.sid AS seed_article, b.id, round(max(list_cosine_similarity(b.e, x.se)), 6) AS similarity FROM x JOIN n ON n.sid = x.sid JOIN b ON b.article_id = n.id WHERE list_cosine_similarity(b.e, x.se) > 0.35 GROUP BY x.sid, b.id""")
def precedents_hybrid(t: Tables) -> DataFrame:
    """A funnel: boxes of articles within a wide neighbourhood, each at its best similarity, nothing near cut. Either similarity is one product of blocks in the same pass."""
    rows = retrieval.usable(t.articles).filter(F.col("published_utc").isNotNull()).select(F.col("id").alias("article_id"), F.col("embedding").alias("gate"))
    boxes = _boxes(t).join(rows, "article_id")
    seeds = boxes.filter("article_id % 50 = 0").withColumnRenamed("id", "seed_id")
    found = nearest(seeds, boxes.select("id", "vector", "gate", "us"), 1 << 30, floor=0.35, keep=lambda s, c: c["us"] < s["us"], gate_floor=0.3)
    hits = found.join(seeds.select("seed_id", F.col("article_id").alias("seed_article")), "seed_id")
    return _rounded(hits.groupBy("seed_article", "id").agg(F.max("similarity").alias("similarity")))


_TOUCH = "x AS (SELECT id, published_utc, unnest(list_distinct([y FOR y IN list_concat([primary_ticker], coalesce(more_tickers, [])) IF y IS NOT NULL])) AS ticker FROM articles WHERE published_utc IS NOT NULL)"


def _touching(t: Tables) -> DataFrame:
    """(id, published_utc, ticker): an equi-join key in place of `primary or any of more`."""
    symbols = F.array_distinct(F.array_compact(F.concat(F.array("primary_ticker"), F.coalesce("more_tickers", F.array().cast("array<string>")))))
    return t.articles.filter(F.col("published_utc").isNotNull()).select("id", "published_utc", F.explode(symbols).alias("ticker"))


@query(f"""WITH {_TOUCH}, r AS (SELECT ticker, x.id AS article_id, i.id, row_number() OVER (PARTITION BY ticker ORDER BY published_utc DESC, x.id, box_index) AS k FROM x JOIN article_insights i ON i.article_id = x.id)
SELECT ticker, article_id, id, CAST(k AS INTEGER) AS rank FROM r WHERE k <= 15""")
def ticker_history(t: Tables) -> DataFrame:
    """The 15 newest boxes of each ticker. Spark limits each task's groups before the shuffle, so a hot ticker ships few rows."""
    boxes = t.article_insights.select("id", "article_id", "box_index")
    joined = _touching(t).withColumnRenamed("id", "article_id").join(boxes, "article_id")
    rank = F.row_number().over(Window.partitionBy("ticker").orderBy(F.desc("published_utc"), "article_id", "box_index"))
    return joined.withColumn("rank", rank).filter("rank <= 15").select("ticker", "article_id", "id", "rank")


@query(f"""WITH {_B}, {_TOUCH}, q AS (SELECT a.id AS sid, a.primary_ticker AS tk, epoch_us(a.published_utc) AS sus FROM articles a WHERE a.id % 50 = 0 AND a.published_utc IS NOT NULL AND a.primary_ticker IS NOT NULL),
s AS (SELECT q.*, b.e AS se FROM q JOIN b ON b.article_id = q.sid),
h AS (SELECT sid, b.id, max(round(list_cosine_similarity(b.e, se), 9)) AS similarity FROM s JOIN x ON x.ticker = tk JOIN b ON b.article_id = x.id WHERE b.article_id <> sid AND b.us < sus GROUP BY sid, b.id)
SELECT sid AS seed_article, id, round(similarity, 6) AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY similarity DESC, id) AS k FROM h) WHERE k <= 20""")
def ticker_relevant(t: Tables) -> DataFrame:
    """The 20 boxes about the article's own ticker that are most similar to its boxes."""
    asking = t.articles.filter("id % 50 = 0 AND published_utc IS NOT NULL").select("id", "primary_ticker")
    boxes = _boxes(t)
    seeds = precedents.own_ticker_seeds(asking, boxes)
    found = precedents.of_ticker(seeds, _touching(t).select(F.col("id").alias("article_id"), "ticker"), boxes, 20)
    best = found.join(seeds.select("seed_id", F.col("article_id").alias("seed_article")), "seed_id").groupBy("seed_article", "id").agg(F.max("similarity").alias("similarity"))
    rank = F.row_number().over(Window.partitionBy("seed_article").orderBy(F.desc("similarity"), "id"))
    return _rounded(best.withColumn("k", rank).filter("k <= 20").select("seed_article", "id", "similarity"))


@query(r"""SELECT article_id, box_index, trim(regexp_replace(coalesce(nullif(insight, ''), topic, ''), '[\s\x{00A0}]+', ' ', 'g')) AS excerpt FROM (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY box_index) AS k FROM article_insights) WHERE k <= 8 AND coalesce(nullif(insight, ''), topic, '') <> ''""")
def own_insights(t: Tables) -> DataFrame:
    """The first eight boxes of each article, blank ones left out after the limit."""
    rank = F.row_number().over(Window.partitionBy("article_id").orderBy("box_index"))
    rows = t.article_insights.select("article_id", "box_index", "insight", "topic").withColumn("k", rank).filter("k <= 8")
    return rows.select("article_id", "box_index", text.excerpt(F.col("insight"), F.col("topic")).alias("excerpt")).filter("excerpt <> ''")


@query(r"""
WITH e AS (SELECT article_id, box_index, trim(regexp_replace(coalesce(nullif(insight, ''), topic, ''), '[\s\x{00A0}]+', ' ', 'g')) AS x FROM article_insights),
g AS (SELECT article_id, list(x ORDER BY box_index) FILTER (WHERE x <> '') AS xs FROM e WHERE box_index < 3 GROUP BY article_id)
SELECT a.id, md5('- ' || strftime(timezone('UTC', a.published_utc), '%Y-%m-%d') || ' ' || coalesce(a.title, '') || CASE WHEN xs IS NULL THEN '' WHEN len(xs) = 1 THEN ' — ' || xs[1] ELSE array_to_string([chr(10) || '    · ' || y FOR y IN xs], '') END) AS digest
FROM g JOIN articles a ON a.id = g.article_id WHERE a.published_utc IS NOT NULL
""")
def precedent_lines(t: Tables) -> DataFrame:
    """Excerpts grouped under their article and rendered."""
    e = t.article_insights.filter("box_index < 3").select("article_id", "box_index", text.excerpt(F.col("insight"), F.col("topic")).alias("x"))
    g = e.groupBy("article_id").agg(F.array_sort(F.collect_list(F.when(F.col("x") != "", F.struct("box_index", "x")))).alias("xs"))
    a = t.articles.filter(F.col("published_utc").isNotNull()).select("id", "title", F.date_format("published_utc", "yyyy-MM-dd").alias("date"))
    line = text.precedent_line(F.col("date"), F.col("title"), F.transform("xs", lambda s: s["x"]))
    return a.join(g, F.col("article_id") == F.col("id")).select("id", F.md5(line).alias("digest"))


def _box_strategy(name: str) -> str:
    """SQL of a box strategy over q (the asking articles), l (boxes with labels) and a."""
    s = precedents.STRATEGIES[name]
    pool = f"SELECT * FROM l WHERE {s.label} IS DISTINCT FROM '{s.leave_out}'" if s.leave_out else "SELECT * FROM l"
    near = f" AND EXISTS (SELECT 1 FROM a WHERE a.id = b.article_id AND a.id <> q.sid AND a.us < q.sus AND round(list_cosine_similarity(a.e, q.qe), 9) > {s.article_floor})" if s.article_floor is not None else ""
    return f"""(SELECT '{name}' AS strategy, seed_article, id, {"label" if s.label else "CAST(NULL AS VARCHAR) AS label"}, round(similarity, 6) AS similarity, CAST(k AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY seed_article ORDER BY similarity DESC, id) AS k FROM (
    SELECT q.sid AS seed_article, b.id, any_value(b.{s.label or "first_label"}) AS label, max(round(list_cosine_similarity(b.e, o.e), 9)) AS similarity
    FROM q JOIN ({pool}) o ON o.article_id = q.sid JOIN ({pool}) b ON b.article_id <> q.sid AND b.us < q.sus WHERE round(list_cosine_similarity(b.e, o.e), 9) > {s.floor}{near} GROUP BY q.sid, b.id)) WHERE k <= {s.limit})"""


_BOX_STRATEGIES = tuple(n for n, s in precedents.STRATEGIES.items() if s.what == "boxes")


def _precedent_tables(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    articles = retrieval.usable(t.articles).filter(F.col("published_utc").isNotNull()).select("id", F.col("embedding").alias("vector"), F.unix_micros("published_utc").alias("us"), "primary_ticker")
    labels = t.article_insights.select("id", "box_index", F.col("model").alias("first_label"), F.when(F.col("box_index") % 3 == 2, "DROP").otherwise(F.col("model")).alias("second_label"))
    return articles, _boxes(t).join(labels, "id"), _touching(t).select(F.col("id").alias("article_id"), "ticker")


@query(f"""WITH {_A}, {_B}, l AS (SELECT b.*, x.model AS first_label, CASE WHEN b.box_index % 3 = 2 THEN 'DROP' ELSE x.model END AS second_label FROM b JOIN article_insights x ON x.id = b.id),
q AS (SELECT id AS sid, e AS qe, us AS sus FROM a WHERE id % 50 = 0 AND us IS NOT NULL) """ + " UNION ALL ".join(map(_box_strategy, _BOX_STRATEGIES)))
def precedents_by_strategy(t: Tables) -> DataFrame:
    """The box strategies side by side: corpora with and without labels, with boxes left out, and narrowed by whole articles first."""
    articles, boxes, touching = _precedent_tables(t)
    out = None
    for name in _BOX_STRATEGIES:
        found = precedents.precedents(name, articles, boxes, F.col("id") % 50 == 0, touching).select(F.lit(name).alias("strategy"), "seed_article", "id", "label", "similarity", "rank")
        out = found if out is None else out.unionByName(found)
    return _rounded(out)


@query(f"""WITH {_B}, {_TOUCH}, q AS (SELECT id AS sid, primary_ticker AS tk, epoch_us(published_utc) AS sus FROM articles WHERE id % 50 = 0 AND published_utc IS NOT NULL AND primary_ticker IS NOT NULL AND {_USABLE})
SELECT sid AS seed_article, id, CAST(k AS INTEGER) AS rank FROM (SELECT sid, b.id, row_number() OVER (PARTITION BY sid ORDER BY b.us DESC, b.article_id, b.box_index) AS k FROM q JOIN x ON x.ticker = tk JOIN b ON b.article_id = x.id WHERE b.us < sus AND b.article_id <> sid) WHERE k <= 15""")
def precedents_of_ticker(t: Tables) -> DataFrame:
    """The strategy that takes the newest earlier boxes about the article's own ticker."""
    articles, boxes, touching = _precedent_tables(t)
    return precedents.precedents("ticker-history", articles, boxes, F.col("id") % 50 == 0, touching).select("seed_article", "id", "rank")
