"""Measures of decisions, labels and retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.operators import metrics
from marketloom.plans.registry import Tables, query
from marketloom.providers import collapsed_labels
from marketloom.semantics import bucketed, stripped

_SAID = "v AS (SELECT s.article_id, a.is_act AS truth, CASE WHEN s.confidence < 0.6 THEN NULL ELSE s.action <> 'hold' END AS said FROM article_sentiment s JOIN articles a ON a.id = s.article_id WHERE a.is_act IS NOT NULL)"


def _verdicts(t: Tables) -> DataFrame:
    a = t.articles.filter(F.col("is_act").isNotNull()).select(F.col("id").alias("article_id"), F.col("is_act").alias("truth"))
    said = F.when(F.col("confidence") >= F.lit(0.6).cast("float"), F.col("action") != "hold")
    return t.article_sentiment.select("article_id", said.alias("said"), "action", "confidence").join(a, "article_id")


_CELLS = """c AS (SELECT count(*) FILTER (WHERE truth AND coalesce(said, NOT truth)) AS tp, count(*) FILTER (WHERE NOT truth AND coalesce(said, NOT truth)) AS fp,
 count(*) FILTER (WHERE truth AND NOT coalesce(said, NOT truth)) AS fn, count(*) FILTER (WHERE NOT truth AND NOT coalesce(said, NOT truth)) AS tn FROM v),
m AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS "precision", CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall FROM c)"""


@query(f"""WITH {_SAID.replace('0.6 THEN', 'CAST(0.6 AS FLOAT) THEN')}, {_CELLS} SELECT tp, fp, fn, tn, (tp + tn) / (tp + fp + fn + tn) AS accuracy, "precision", recall, CASE WHEN "precision" + recall > 0 THEN 2 * "precision" * recall / ("precision" + recall) ELSE 0 END AS f1 FROM m""")
def binary_confusion(t: Tables) -> DataFrame:
    """Acting or not against the label; a missing answer counts as wrong."""
    return metrics.binary(_verdicts(t), F.col("truth"), F.col("said"))


_CLASSES = """x AS (SELECT a.category AS truth, b.category AS said FROM articles a LEFT JOIN articles b ON b.id = a.id + 1),
l AS (SELECT DISTINCT label FROM (SELECT truth AS label FROM x UNION ALL SELECT said FROM x) WHERE label IS NOT NULL),
k AS (SELECT label, (SELECT count(*) FROM x WHERE truth = label AND said = label) AS tp, (SELECT count(*) FROM x WHERE said = label AND truth IS DISTINCT FROM label) AS fp, (SELECT count(*) FROM x WHERE truth = label AND said IS DISTINCT FROM label) AS fn FROM l),
p AS (SELECT *, tp + fn AS support, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS pr, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS re FROM k),
f AS (SELECT *, CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END AS f1 FROM p)"""


def _classes(t: Tables) -> DataFrame:
    """Each article's category against that of the next id, as a stand-in for a second answer."""
    a = t.articles.select("id", F.col("category").alias("truth"))
    b = t.articles.select((F.col("id") - 1).alias("id"), F.col("category").alias("said"))
    return metrics.per_class(a.join(b, "id", "left"), "truth", "said")


@query(f"""WITH {_CLASSES} SELECT label, tp, fp, fn, support, pr AS "precision", re AS recall, f1 FROM f""")
def multiclass_per_label(t: Tables) -> DataFrame:
    return _classes(t)


@query(f"""WITH {_CLASSES} SELECT avg(pr) AS macro_precision, avg(re) AS macro_recall, avg(f1) AS macro_f1, sum(f1 * support) / sum(support) AS weighted_f1, count(*) AS classes FROM f""")
def multiclass_macro_weighted(t: Tables) -> DataFrame:
    return metrics.averaged(_classes(t))


_SETS = """s AS (SELECT category, id, [upper(trim(x)) FOR x IN tickers IF x IS NOT NULL] AS e, list_concat([primary_ticker], coalesce(more_tickers, [])) AS r FROM articles WHERE tickers IS NOT NULL AND category IS NOT NULL AND primary_ticker IS NOT NULL),
d AS (SELECT category, id, list_distinct(e) AS e, list_distinct(r) AS r FROM s),
c AS (SELECT category, id, len(list_intersect(e, r)) AS tp, len([x FOR x IN r IF NOT list_contains(e, x)]) AS fp, len([x FOR x IN e IF NOT list_contains(r, x)]) AS fn FROM d),
m AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS r FROM c)"""


def _sets(t: Tables) -> DataFrame:
    rows = t.articles.filter("tickers IS NOT NULL AND category IS NOT NULL AND primary_ticker IS NOT NULL")
    e = F.filter(F.transform("tickers", lambda x: F.upper(stripped(x))), lambda x: x.isNotNull())
    r = F.filter(F.concat(F.array("primary_ticker"), F.coalesce("more_tickers", F.array().cast("array<string>"))), lambda x: x.isNotNull())
    return metrics.retrieval(rows.select("category", "id", e.alias("e"), r.alias("r")), "e", "r")


@query(f"""WITH {_SETS} SELECT id, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, p AS "precision", r AS recall FROM m""")
def retrieval_cells(t: Tables) -> DataFrame:
    return _sets(t).select("id", F.col("tp").cast("bigint").alias("tp"), F.col("fp").cast("bigint").alias("fp"), F.col("fn").cast("bigint").alias("fn"), "precision", "recall")


@query(f"""WITH {_SETS}, g AS (SELECT category, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn, avg(p) AS mp, avg(r) AS mr FROM m GROUP BY category)
SELECT category, tp, fp, fn, mp AS macro_precision, mr AS macro_recall, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS micro_precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS micro_recall FROM g""")
def retrieval_micro_macro(t: Tables) -> DataFrame:
    out = metrics.micro_macro(_sets(t), ["category"])
    return out.select("category", "tp", "fp", "fn", "macro_precision", "macro_recall", "micro_precision", "micro_recall")


@query("""
WITH b(bucket) AS (VALUES ('<0.7'), ('0.7-0.85'), ('>=0.85')),
v AS (SELECT CASE WHEN confidence < CAST(0.7 AS FLOAT) THEN '<0.7' WHEN confidence < CAST(0.85 AS FLOAT) THEN '0.7-0.85' WHEN confidence IS NOT NULL THEN '>=0.85' END AS bucket, action FROM article_sentiment)
SELECT b.bucket, count(v.action) AS n, count(*) FILTER (WHERE v.action = 'buy') AS buys FROM b LEFT JOIN v USING (bucket) GROUP BY b.bucket
""")
def confidence_buckets(t: Tables) -> DataFrame:
    """Counts per bucket of confidence; empty buckets stay."""
    labels = ["<0.7", "0.7-0.85", ">=0.85"]
    rows = t.article_sentiment.select(bucketed(F.col("confidence").cast("float"), [F.lit(0.7).cast("float"), F.lit(0.85).cast("float")], labels).alias("bucket"), "action")
    domain = t.spark.createDataFrame([(x,) for x in labels], "bucket string")
    return domain.join(rows, "bucket", "left").groupBy("bucket").agg(F.count("action").alias("n"), F.count_if(F.col("action") == "buy").alias("buys"))


@query("""SELECT model, action, count(*) AS n, avg(CAST(confidence AS DOUBLE)) AS mean FROM article_sentiment GROUP BY model, action""")
def verdict_summary(t: Tables) -> DataFrame:
    return t.article_sentiment.groupBy("model", "action").agg(F.count("*").alias("n"), F.avg(F.col("confidence").cast("double")).alias("mean"))


@query("""SELECT coalesce(is_act, category = 'macro news') AS acts, count(*) AS n FROM articles GROUP BY 1""")
def three_valued_flag(t: Tables) -> DataFrame:
    return t.articles.groupBy(F.coalesce("is_act", F.col("category") == "macro news").alias("acts")).agg(F.count("*").alias("n"))


@query("""
SELECT CASE WHEN trim(coalesce(category, '')) = '' THEN NULL WHEN lower(trim(category)) IN ('earnings report', 'contract win', 'product launch') THEN 'act' WHEN lower(trim(category)) IN ('macro news', 'market commentary') THEN 'skip' ELSE 'other' END AS label_group, count(*) AS n, count(DISTINCT category) AS labels
FROM articles GROUP BY 1
""")
def label_collapse(t: Tables) -> DataFrame:
    """Fine labels collapsed to groups."""
    group = collapsed_labels(F.col("category"), {"act": ("earnings report", "contract win", "product launch"), "skip": ("macro news", "market commentary")})
    return t.articles.groupBy(group.alias("label_group")).agg(F.count("*").alias("n"), F.countDistinct("category").alias("labels"))


@query("""
SELECT s.model, count(*) AS items, count(s.action) AS answered, avg(CAST((s.action <> 'hold') = a.is_act AS INTEGER)) AS act_accuracy, avg(CASE WHEN s.action <> 'hold' THEN CAST(s.confidence AS DOUBLE) END) AS mean_confidence_of_acts,
  CAST(sum(coalesce(length(s.reasoning), 0) + coalesce(length(s.analyses), 0)) AS BIGINT) AS chars_out, avg(date_diff('second', a.published_utc, s.created_at)) AS mean_seconds
FROM article_sentiment s JOIN articles a ON a.id = s.article_id GROUP BY s.model
""")
def evaluation_totals(t: Tables) -> DataFrame:
    """Totals of a run per model: items, answers, accuracy of the derived decision, confidence where it acts, size of the output, time from publication to answer."""
    a = t.articles.select(F.col("id").alias("article_id"), "is_act", "published_utc")
    acts = F.col("action") != "hold"
    return t.article_sentiment.join(a, "article_id").groupBy("model").agg(
        F.count("*").alias("items"), F.count("action").alias("answered"), F.avg((acts == F.col("is_act")).cast("int")).alias("act_accuracy"), F.avg(F.when(acts, F.col("confidence").cast("double"))).alias("mean_confidence_of_acts"),
        F.sum(F.coalesce(F.length("reasoning"), F.lit(0)) + F.coalesce(F.length("analyses"), F.lit(0))).alias("chars_out"), F.avg(F.unix_seconds("created_at") - F.unix_seconds("published_utc")).alias("mean_seconds"),
    )
