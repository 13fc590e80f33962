"""The queries of the problems, and the SQL for those that SQL can express."""

from __future__ import annotations

import importlib
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import boilerplate, canonical, cooccur, languages, mixture, personal, repeated_lines, residue, similar, tokens
from marketloom.session import checkpointed, table


def vocabulary_path() -> str:
    """Path of the public vocabulary: $MARKETLOOM_BPE, else the folder of public tokenizers of this machine."""
    if named := os.environ.get("MARKETLOOM_BPE"):
        return named
    return importlib.import_module("public_tokenizers").path("byte_bpe_50k.tiktoken")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.unusable(table(spark, sf_dir, "articles")).filter("unusable").select("id")


def p1_usable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every article's mark, score and reason."""
    return residue.unusable(table(spark, sf_dir, "articles"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_lines.find_repeated_lines(table(spark, sf_dir, "articles")).select("id", "line_no")


def p2_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles = table(spark, sf_dir, "articles")
    return repeated_lines.without_lines(articles, repeated_lines.find_repeated_lines(articles))


def p2_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The templates of the merged trees that cover at least four documents."""
    return repeated_lines.templates(table(spark, sf_dir, "articles"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = None
    for name in ("articles", "article_insights"):
        pairs = similar.close_pairs(table(spark, sf_dir, name), min_similarity=0.85, target_recall=0.999).select(F.lit(name).alias("table_name"), "id_a", "id_b")
        found = pairs if found is None else found.unionByName(pairs)
    return found


def p3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 most similar of every row whose id is divisible by 50, against all rows."""
    found = None
    for name in ("articles", "article_insights"):
        near = similar.most_similar(table(spark, sf_dir, name), k=5, target_recall=0.95, queries=F.col("id") % 50 == 0)
        near = near.select(F.lit(name).alias("table_name"), "id", "other_id", "similarity")
        found = near if found is None else found.unionByName(near)
    return found


def p3_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the calibrated index of either table reaches on queries that took no part in its calibration, against brute force over all rows."""
    rows = []
    for name in ("articles", "article_insights"):
        for search, options in (("close", {"min_similarity": 0.85, "target_recall": 0.999}), ("neighbours", {"target_recall": 0.95, "queries": F.col("id") % 50 == 0})):
            index = similar.index_of(table(spark, sf_dir, name), k=5, **options)
            if index:
                rows.append((name, search, index.rows, index.tree.leaves, index.visits, index.queries, index.recall))
    return spark.createDataFrame(rows, "table_name string, search string, n_rows bigint, leaves int, visits int, queries int, recall double")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = languages.label_languages(table(spark, sf_dir, "articles")).filter((F.col("lang") != languages.UNKNOWN) & ((F.col("line_no") > 0) | ~F.col("label_right")))
    return labelled.join(p1_found(spark, sf_dir), "id", "left_anti").select("id", "line_no", "lang")


def p4_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every article's and every foreign line's language with its confidence."""
    return languages.label_languages(table(spark, sf_dir, "articles"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = boilerplate.boilerplate_lines(table(spark, sf_dir, "articles"))
    return lines.join(p1_found(spark, sf_dir), "id", "left_anti").select("id", "line_no")


def p5_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every article's content without the lines that are no part of the story."""
    articles = table(spark, sf_dir, "articles")
    return repeated_lines.without_lines(articles, boilerplate.boilerplate_lines(articles), out_col="body")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = cooccur.lifted_pairs(table(spark, sf_dir, "articles"), min_count=5, min_lift=3.0)
    return pairs.select(F.col("item_a").alias("ticker_a"), F.col("item_b").alias("ticker_b"))


def p6_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = cooccur.lifted_pairs(table(spark, sf_dir, "articles"))
    return pairs.select(F.col("item_a").alias("ticker_a"), F.col("item_b").alias("ticker_b"), "n_ab", "n_a", "n_b", "n_records", "lift")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.pairs(table(spark, sf_dir, "articles"))


def p7_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.collapse(table(spark, sf_dir, "articles"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode(table(spark, sf_dir, "documents"), vocabulary_path())


def _mixture(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    counted = checkpointed(tokens.count_tokens(table(spark, sf_dir, "documents"), vocabulary_path()))  # three short columns, encoded once
    rated = mixture.rates(counted, table(spark, sf_dir, "mix_targets"))
    return mixture.uses(counted, rated), rated


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixture(spark, sf_dir)[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.shares(*_mixture(spark, sf_dir))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.find_pieces(table(spark, sf_dir, "documents"))


def p10_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with typed placeholders."""
    return personal.redact(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found, "p1_usable": p1_usable, "p2_found": p2_found, "p2_clean": p2_clean, "p2_templates": p2_templates, "p3_found": p3_found, "p3_neighbours": p3_neighbours, "p3_recall": p3_recall, "p4_found": p4_found, "p4_languages": p4_languages, "p5_found": p5_found, "p5_body": p5_body, "p6_found": p6_found, "p6_pairs": p6_pairs, "p7_found": p7_found, "p7_groups": p7_groups,
    "p8_ids": p8_ids, "p9_mix": p9_mix, "p9_shares": p9_shares, "p10_found": p10_found, "p10_redacted": p10_redacted,
}

_LINES = r"""
lines AS (
  SELECT id, source_domain, i AS line_no,
         trim(regexp_replace(regexp_replace(lower(parts[i]), '[\s\x{00A0}\x{2000}-\x{200A}\x{202F}\x{3000}\x{2028}\x{2029}\x{0085}]+', ' ', 'g'), '\d+', '0', 'g')) AS t
  FROM (SELECT id, source_domain, parts, unnest(range(1, len(parts) + 1)) AS i
        FROM (SELECT id, source_domain, string_split(content, chr(10)) AS parts FROM articles WHERE content IS NOT NULL))
),
covering AS (SELECT source_domain, t FROM lines WHERE t <> '' GROUP BY 1, 2 HAVING count(DISTINCT id) >= 4)
"""
_BASKETS = r"""
baskets AS (
  SELECT id, list_distinct([x FOR x IN [upper(regexp_replace(regexp_replace(y, '^[\s\x{00A0}]*\$*[\s\x{00A0}]*', ''), '[\s\x{00A0}]+$', '')) FOR y IN tickers IF y IS NOT NULL] IF x <> '']) AS items
  FROM articles WHERE tickers IS NOT NULL
),
rows_ AS (SELECT id, unnest(items) AS t FROM baskets WHERE len(items) > 0),
n AS (SELECT count(*) AS n_records FROM baskets WHERE len(items) > 0),
single AS (SELECT t, count(*) AS c FROM rows_ GROUP BY t),
both_ AS (SELECT a.t AS ticker_a, b.t AS ticker_b, count(*) AS n_ab FROM rows_ a JOIN rows_ b ON a.id = b.id AND a.t < b.t GROUP BY 1, 2),
pairs AS (
  SELECT ticker_a, ticker_b, n_ab, x.c AS n_a, y.c AS n_b, n_records, n_ab * n_records / (x.c * y.c)::DOUBLE AS lift
  FROM both_ JOIN single x ON x.t = ticker_a JOIN single y ON y.t = ticker_b CROSS JOIN n
)
"""

# an address reduced to a key: case, white space, punctuation, escapes, scheme, www., fragment, order of fields, empty and tracking fields don't count
_ADDRESSES = r"""
raw AS (SELECT id, CASE WHEN regexp_matches(coalesce(url_canonical, ''), '^[\s\x{00A0}]*$') THEN url ELSE url_canonical END AS u FROM articles),
bare AS (SELECT id, u, regexp_replace(lower(regexp_replace(split_part(regexp_replace(u, '[\s\x{00A0}]+', '', 'g'), '#', 1), '^[^\pL\pN]+', '')), '^(?:[a-z][a-z0-9+.\-]*:)?/*(?:www\.)?', '') AS b FROM raw),
cut AS (SELECT id, u, split_part(b, '?', 1) AS place, regexp_replace(b, '^[^?]*\??', '') AS query FROM bare),
decoded AS (SELECT id, u, regexp_replace(lower(url_decode(url_decode(replace(place, '+', '%2B')))), '[^\pL\pN\pM]+', '', 'g') AS place,
  [struct_pack(k := regexp_replace(lower(url_decode(url_decode(split_part(f, '=', 1)))), '[^\pL\pN\pM_]+', '', 'g'), v := regexp_replace(lower(url_decode(url_decode(regexp_replace(f, '^[^=]*=?', '')))), '[^\pL\pN\pM]+', '', 'g')) FOR f IN regexp_split_to_array(query, '[&;]')] AS fields FROM cut),
keys AS (SELECT id, CASE WHEN regexp_matches(coalesce(u, ''), '^[\s\x{00A0}]*$') THEN chr(1) || id ELSE place || '?' || array_to_string(list_sort([regexp_replace(f.k, '_', '', 'g') || '=' || f.v FOR f IN fields
  IF f.v <> '' AND f.k NOT IN ('source', 'ref', 'fbclid', 'gclid', 'mc_cid', 'mc_eid', 'yptr') AND NOT starts_with(f.k, 'utm_')]), '&') END AS key FROM decoded)
"""
_CLOSE = """
SELECT '{table}' AS table_name, id_a, id_b FROM (
  SELECT least(a, b) AS id_a, greatest(a, b) AS id_b FROM (
    SELECT x.id AS a, y.id AS b, round(list_cosine_similarity(x.e, y.e), 9) AS s, row_number() OVER (PARTITION BY x.id ORDER BY round(list_cosine_similarity(x.e, y.e), 9) DESC, y.id) AS k
    FROM {table}_v x JOIN {table}_v y ON x.id <> y.id) WHERE k <= 5 AND s >= 0.85 GROUP BY 1, 2)
"""
_VECTORS = ", ".join(f"{x}_v AS (SELECT id, embedding::DOUBLE[] AS e FROM {x} WHERE embedding IS NOT NULL AND len(embedding) > 0 AND list_max([abs(y) FOR y IN embedding]) > 0)" for x in ("articles", "article_insights"))

ORACLE_SQL: dict[str, str] = {
    "p2_clean": f"""WITH {_LINES}, found AS (SELECT l.id, l.line_no FROM lines l JOIN covering c ON c.source_domain IS NOT DISTINCT FROM l.source_domain AND c.t = l.t),
      g AS (SELECT id, list(line_no) AS gone FROM found GROUP BY id), x AS (SELECT a.id, string_split(content, chr(10)) AS parts, coalesce(gone, []) AS gone FROM articles a LEFT JOIN g USING (id))
      SELECT id, array_to_string([parts[i] FOR i IN range(1, len(parts) + 1) IF NOT list_contains(gone, i)], chr(10)) AS clean, CAST(len(gone) AS INTEGER) AS removed FROM x""",
    "p3_found": f"WITH {_VECTORS} {_CLOSE.format(table='articles')} UNION ALL {_CLOSE.format(table='article_insights')}",
    "p7_found": f"WITH {_ADDRESSES} SELECT a.id AS id_a, b.id AS id_b FROM keys a JOIN keys b ON a.key = b.key AND a.id < b.id",
    "p7_groups": f"WITH {_ADDRESSES} SELECT min(id) AS id, count(*) AS copies FROM keys GROUP BY key",
    "p2_found": f"WITH {_LINES} SELECT l.id, CAST(l.line_no AS INTEGER) AS line_no FROM lines l JOIN covering c ON c.source_domain IS NOT DISTINCT FROM l.source_domain AND c.t = l.t",
    "p6_found": f"WITH {_BASKETS} SELECT ticker_a, ticker_b FROM pairs WHERE n_ab >= 5 AND n_ab * n_records >= 3 * n_a * n_b",
    "p6_pairs": f"WITH {_BASKETS} SELECT * FROM pairs",
}
