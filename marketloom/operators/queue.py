"""A work queue as a table: what follows from failures, restarts and requests to try again. Each step gives the table's next version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.semantics import backoff_seconds


def after_failures(jobs: DataFrame, failures: DataFrame, now: Column, *, key: str = "article_url", most: int = 5) -> DataFrame:
    """Jobs after failures (key, error, permanent): one more attempt each; failed for good at `most` attempts or a permanent error, else pending again after the delay."""
    once = failures.groupBy(key).agg(F.max("error").alias("_error"), F.bool_or(F.coalesce("permanent", F.lit(False))).alias("_permanent"))
    joined = jobs.join(once, key, "left")
    hit, tries = F.col("_permanent").isNotNull(), F.col("attempts") + 1
    over = F.col("_permanent") | (tries >= most)
    return joined.withColumns({
        "status": F.when(hit, F.when(over, "failed").otherwise("pending")).otherwise(F.col("status")),
        "last_error": F.when(hit, F.substring("_error", 1, 2000)).otherwise(F.col("last_error")),
        "next_attempt_at": F.when(hit & ~over, now + F.make_dt_interval(secs=backoff_seconds(tries - 1))).otherwise(F.col("next_attempt_at")),
        "attempts": F.when(hit, tries).otherwise(F.col("attempts")),
    }).drop("_error", "_permanent")


def requeued(jobs: DataFrame, now: Column, where: Column | None = None) -> DataFrame:
    """Failed jobs (that `where` selects) pending again, with no attempts."""
    hit = F.coalesce((F.col("status") == "failed") & (where if where is not None else F.lit(True)), F.lit(False))
    return jobs.withColumns({"status": F.when(hit, "pending").otherwise(F.col("status")), "attempts": F.when(hit, 0).otherwise(F.col("attempts")), "next_attempt_at": F.when(hit, now).otherwise(F.col("next_attempt_at"))})


def recovered(jobs: DataFrame) -> DataFrame:
    """Jobs of a run that died: running ones are pending again."""
    return jobs.withColumn("status", F.when(F.col("status") == "running", "pending").otherwise(F.col("status")))
