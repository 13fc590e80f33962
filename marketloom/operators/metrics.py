"""Quality measures as single aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column, empty: float | None = 0.0) -> Column:
    """part / whole; `empty` where the whole is 0."""
    return F.when(whole != 0, part / whole).otherwise(F.lit(empty).cast("double"))


def f1(precision: Column, recall: Column) -> Column:
    return F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(F.lit(0.0))


def binary(df: DataFrame, truth: Column, said: Column, *, empty: float | None = 0.0, by: list[str] | None = None) -> DataFrame:
    """tp, fp, fn, tn, accuracy, precision, recall, f1. A null answer is a wrong one: it counts against the class of its truth."""
    yes = F.coalesce(said, ~truth)
    cells = df.groupBy(*(by or [])).agg(F.count_if(truth & yes).alias("tp"), F.count_if(~truth & yes).alias("fp"), F.count_if(truth & ~yes).alias("fn"), F.count_if(~truth & ~yes).alias("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    out = cells.withColumns({"accuracy": ratio(tp + tn, tp + fp + fn + tn, empty), "precision": ratio(tp, tp + fp, empty), "recall": ratio(tp, tp + fn, empty)})
    return out.withColumn("f1", f1(F.coalesce("precision", F.lit(0.0)), F.coalesce("recall", F.lit(0.0))))


def per_class(df: DataFrame, truth: str, said: str) -> DataFrame:
    """(label, tp, fp, fn, support, precision, recall, f1) of every label in either column; a null answer is a miss only."""
    gold = df.filter(F.col(truth).isNotNull()).select(F.col(truth).alias("label"), F.when(F.col(said) == F.col(truth), 1).otherwise(0).alias("tp"), F.lit(0).alias("fp"), F.when(F.col(said) == F.col(truth), 0).otherwise(1).alias("fn"))
    wrong = df.filter(F.col(said).isNotNull() & ~F.col(said).eqNullSafe(F.col(truth))).select(F.col(said).alias("label"), F.lit(0).alias("tp"), F.lit(1).alias("fp"), F.lit(0).alias("fn"))
    sums = gold.unionByName(wrong).groupBy("label").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
    out = sums.withColumns({"support": F.col("tp") + F.col("fn"), "precision": ratio(F.col("tp"), F.col("tp") + F.col("fp")), "recall": ratio(F.col("tp"), F.col("tp") + F.col("fn"))})
    return out.withColumn("f1", f1(F.col("precision"), F.col("recall")))


def averaged(classes: DataFrame) -> DataFrame:
    """Macro means and the mean weighted by support, of `per_class`."""
    return classes.agg(F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"), F.avg("f1").alias("macro_f1"), ratio(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("weighted_f1"), F.count("*").alias("classes"))


def retrieval(sets: DataFrame, expected: str, retrieved: str) -> DataFrame:
    """The rows with tp, fp, fn, precision, recall and f1 of two arrays of ids each."""
    e, r = F.array_distinct(F.coalesce(expected, F.array())), F.array_distinct(F.coalesce(retrieved, F.array()))
    cells = sets.withColumns({"tp": F.size(F.array_intersect(e, r)), "fp": F.size(F.array_except(r, e)), "fn": F.size(F.array_except(e, r))})
    out = cells.withColumns({"precision": ratio(F.col("tp"), F.col("tp") + F.col("fp")), "recall": ratio(F.col("tp"), F.col("tp") + F.col("fn"))})
    return out.withColumn("f1", f1(F.col("precision"), F.col("recall")))


def micro_macro(cells: DataFrame, by: list[str]) -> DataFrame:
    """Micro measures from the summed cells and macro measures as means."""
    sums = cells.groupBy(*by).agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"), F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"), F.avg("f1").alias("macro_f1"))
    out = sums.withColumns({"micro_precision": ratio(F.col("tp"), F.col("tp") + F.col("fp")), "micro_recall": ratio(F.col("tp"), F.col("tp") + F.col("fn"))})
    return out.withColumn("micro_f1", f1(F.col("micro_precision"), F.col("micro_recall")))
