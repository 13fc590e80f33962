"""Mixing sources to target weights.

Method: tokens are aggregated per source; the repetition rate of source s is target_share * total / tokens of s, at most its
max_repeats; a document is then emitted floor(rate) times, plus once more with probability rate - floor(rate), drawn from a
seeded hash of its identifier, so that every run and every task agrees.

The total: without `total_tokens` the mixture is as large as it can be while every present source keeps its share within its
max_repeats. With a `total_tokens` beyond that, capped sources stay at their cap and the others make up the total in
proportion to their targets (water-filling).

Defined results: sources without a target, with a null name or a share of null or 0 are not used (0 uses); a target whose source is
absent or has no tokens is reported with actual share 0, and its share is spread over the others in proportion; a null
max_repeats means 1; a source listed twice is one source with the summed share and the smaller cap; null and empty texts have no tokens and
follow their source's rate; an empty table gives no uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HASH_BITS = 52


def rates(tokens: DataFrame, targets: DataFrame, total_tokens: float | None = None) -> DataFrame:
    """(source, target_share, max_repeats, tokens, rate): one row per listed source. Targets are a small table (a row per source)."""
    have = tokens.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    wanted = targets.filter(F.col("source").isNotNull()).groupBy("source").agg(F.sum("target_share").alias("target_share"), F.min(F.coalesce("max_repeats", F.lit(1))).alias("max_repeats"))
    listed = wanted.join(have, "source", "left").withColumn("tokens", F.coalesce("tokens", F.lit(0)))
    rows = listed.collect()  # one row per listed source
    live = {r.source: r for r in rows if r.tokens > 0 and (r.target_share or 0) > 0 and r.max_repeats > 0}
    weight = sum(r.target_share for r in live.values())
    most = min((r.max_repeats * r.tokens * weight / r.target_share for r in live.values()), default=0.0)
    total, rate = most if total_tokens is None else float(total_tokens), {}
    open_, left = dict(live), total
    while open_:
        weight = sum(r.target_share for r in open_.values())
        capped = [s for s, r in open_.items() if left * r.target_share / weight > r.max_repeats * r.tokens * (1 + 1e-12)]
        if not capped:
            rate |= {s: min(float(r.max_repeats), left * r.target_share / weight / r.tokens) for s, r in open_.items()}
            break
        for s in capped:
            r = open_.pop(s)
            rate[s] = float(r.max_repeats)
            left -= r.max_repeats * r.tokens
    data = [(r.source, float(r.target_share or 0), int(r.max_repeats), int(r.tokens), float(rate.get(r.source, 0.0))) for r in rows]
    return tokens.sparkSession.createDataFrame(data, "source string, target_share double, max_repeats int, tokens bigint, rate double")


def uses(tokens: DataFrame, rated: DataFrame, *, id_col: str = "doc_id", seed: int = 42) -> DataFrame:
    """(id_col, source, n_tokens, uses) of every document; the rates have a row per listed source, so their join is a broadcast."""
    u = F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.lit(seed)), 64 - HASH_BITS) / F.lit(float(1 << HASH_BITS))
    joined = tokens.join(F.broadcast(rated.select("source", "rate")), "source", "left").withColumn("rate", F.coalesce("rate", F.lit(0.0)))
    whole = F.floor("rate")
    return joined.select(id_col, "source", "n_tokens", (whole + F.when(u < F.col("rate") - whole, 1).otherwise(0)).cast("int").alias("uses"))


def shares(used: DataFrame, rated: DataFrame) -> DataFrame:
    """(source, target_share, max_repeats, tokens, rate, used_tokens, actual_share, expected_share, standard_error): the report.

    `expected_share` is what the rates give on average, `standard_error` how far the draws of whole documents usually take the actual share from it.
    """
    size = F.col("n_tokens").cast("double")
    sums = used.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("uses")).alias("used_tokens"), F.sum(size * size).alias("_squares"))
    joined = rated.join(sums, "source", "left").withColumn("used_tokens", F.coalesce("used_tokens", F.lit(0)))
    total = joined.agg(F.sum("used_tokens").alias("_total"), F.sum(F.col("rate") * F.col("tokens")).alias("_expected"))
    part = F.col("rate") - F.floor("rate")
    of = lambda c, whole: F.when(F.col(whole) > 0, c / F.col(whole)).otherwise(0.0)
    report = joined.crossJoin(F.broadcast(total))  # one row
    return report.select("source", "target_share", "max_repeats", "tokens", "rate", "used_tokens", of(F.col("used_tokens"), "_total").alias("actual_share"), of(F.col("rate") * F.col("tokens"), "_expected").alias("expected_share"), of(F.sqrt(part * (1 - part) * F.coalesce("_squares", F.lit(0.0))), "_expected").alias("standard_error"))
