"""Writes by key, as joins: the result is the table's next version, to be written beside the old one and swapped in.

Every function needs one shuffle of either side on the key, none where both are bucketed by it. A catalogue with row-level writes
can take `delta` as the source of its MERGE instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(delta: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key: the last by `order`."""
    rest = [c for c in delta.columns if c not in keys]
    return delta.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_d")).select(*keys, "_d.*")


def one_per_key(delta: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """One row per key: the last by `order`, else one of them whole."""
    if order:
        return latest(delta, keys, order)
    rest = [c for c in delta.columns if c not in keys]
    if not rest:
        return delta.dropDuplicates(keys)
    return delta.groupBy(*keys).agg(F.first(F.struct(*rest)).alias("_d")).select(*keys, "_d.*")


def upsert(base: DataFrame, delta: DataFrame, keys: list[str], *, keep: tuple[str, ...] = (), null_on_update: tuple[str, ...] = (), order: str | None = None) -> DataFrame:
    """Rows of `delta` replace those of their key or are added; `keep` columns stay as they were on an update, others may be nulled by one.

    Of several delta rows of one key the last by `order` counts, or any one of them.
    """
    delta = one_per_key(delta, keys, order)
    b = base.select(*keys, F.struct(*base.columns).alias("_b"))
    d = delta.select(*keys, F.struct(*delta.columns).alias("_d"))
    joined = b.join(d, keys, "full_outer")
    both = F.col("_b").isNotNull() & F.col("_d").isNotNull()
    out = []
    for c in base.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in keep or c not in delta.columns:
            value = F.when(F.col("_b").isNotNull(), F.col(f"_b.{c}")).otherwise(F.col(f"_d.{c}") if c in delta.columns else F.lit(None))
            out.append((F.when(both, None).otherwise(value) if c in null_on_update else value).alias(c))
        else:
            out.append(F.when(both & F.lit(c in null_on_update), None).when(F.col("_d").isNotNull(), F.col(f"_d.{c}")).otherwise(F.col(f"_b.{c}")).alias(c))
    return joined.select(*out)


def insert_absent(base: DataFrame, delta: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """`base` and the rows of `delta` whose key it lacks, each key once."""
    return base.unionByName(one_per_key(delta, keys, order).join(base.select(*keys), keys, "left_anti").select(*base.columns))


def set_if_null(base: DataFrame, delta: DataFrame, keys: list[str], column: str) -> DataFrame:
    """`column` filled from `delta` where it is null."""
    new = one_per_key(delta.select(*keys, F.col(column).alias("_new")), keys)
    return base.join(new, keys, "left").withColumn(column, F.coalesce(column, "_new")).drop("_new")


def delete(base: DataFrame, keys_of: DataFrame, keys: list[str]) -> DataFrame:
    return base.join(keys_of.select(*keys), keys, "left_anti")


def reset(base: DataFrame, columns: list[str], where) -> DataFrame:
    """The columns nulled in the rows that `where` selects."""
    return base.withColumns({c: F.when(~F.coalesce(where, F.lit(False)), F.col(c)) for c in columns})


def pending(base: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that have no counterpart in `done`."""
    return base.join(done.select(*keys).distinct(), keys, "left_anti")


def readiness(wanted: DataFrame, articles: DataFrame) -> DataFrame:
    """One row of counts: of the wanted (article_id) how many are missing, not ok, without content or date, and usable."""
    a = articles.select("id", "status", "published_utc", F.coalesce(F.trim("content"), F.lit("")).alias("c"))
    joined = wanted.join(a, F.col("article_id") == F.col("id"), "left")
    there, ok = F.col("id").isNotNull(), F.coalesce(F.col("status") == "ok", F.lit(False))
    return joined.agg(
        F.count("*").alias("wanted"), F.count_if(~there).alias("missing"), F.count_if(there & ~ok).alias("not_ok"), F.count_if(there & (F.col("c") == "")).alias("without_content"),
        F.count_if(there & F.col("published_utc").isNull()).alias("without_date"), F.count_if(ok & (F.col("c") != "") & F.col("published_utc").isNotNull()).alias("usable"),
    )


def checked_ready(wanted: DataFrame, articles: DataFrame) -> DataFrame:
    """The wanted articles; an error that counts what is wrong unless all of them are usable."""
    r = readiness(wanted, articles).first()
    if r.usable < r.wanted:
        raise ValueError(f"{r.wanted - r.usable} of {r.wanted} articles can't be evaluated: {r.missing} missing, {r.not_ok} not ok, {r.without_content} without content, {r.without_date} without date")
    return articles.join(wanted.select(F.col("article_id").alias("id")), "id", "left_semi")
