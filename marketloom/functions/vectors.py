"""Similarity of stored vectors. Blocks of vectors are multiplied in numpy over Arrow batches, so nothing is per row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGITS = 9
SEED_BLOCK = 2048  # seeds that are broadcast together


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows at length 1; rows of zeros become NaN, which no comparison keeps."""
    with np.errstate(invalid="ignore", divide="ignore"):
        return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def cosine_to(column: Column, vector: list[float]) -> Column:
    """Cosine with one given vector; null for null, empty, zero or differently sized vectors."""
    target = np.asarray(vector, np.float64)
    target = target / np.linalg.norm(target)

    @F.pandas_udf("double")
    def cosine(values: pd.Series) -> pd.Series:
        out = np.full(len(values), np.nan)
        fit = np.flatnonzero(values.map(lambda v: v is not None and len(v) == len(target)))
        if len(fit):
            out[fit] = np.round(unit(np.stack(values.iloc[fit].to_numpy()).astype(np.float64)) @ target, DIGITS)
        return pd.Series(out).where(np.isfinite(out), None)

    return cosine(column)


def nearest(seeds: DataFrame, corpus: DataFrame, k: int, *, floor: float = -1.0, keep: Callable[[dict, dict], np.ndarray] | None = None, gate_floor: float | None = None) -> DataFrame:
    """(seed_id, id, similarity): each seed's k most similar corpus rows above `floor`.

    seeds (seed_id bigint, vector, plus what `keep` needs), corpus (id bigint, vector, plus the same). `keep` is given the other columns of the
    seeds (as columns) and of the corpus (as rows), numpy arrays by name that broadcast against each other; pairs where it is false are no candidates.
    With `gate_floor` both have a second vector, `gate` (a box's whole article, say), and pairs whose gates are not more similar than that are no candidates:
    a funnel of two similarities in one pass, without a shuffle of either vector.
    Seeds are a stated query set: they are broadcast in blocks of about `SEED_BLOCK`, each block against all rows, with a partial top-k per batch.
    """
    names = [c for c in corpus.columns if c not in ("id", "vector", "gate")]
    spark, parts = seeds.sparkSession, []
    blocks = max(1, -(-seeds.count() // SEED_BLOCK))
    for number in range(blocks):  # the driver holds one block at a time
        block = seeds.filter(F.pmod(F.xxhash64("seed_id"), F.lit(blocks)) == number).toPandas()
        stacked = lambda c: unit(np.stack(block[c].to_numpy()).astype(np.float64)) if len(block) else np.zeros((0, 1))  # noqa: B023, E731
        shared = spark.sparkContext.broadcast((stacked("vector"), stacked("gate") if gate_floor is not None else None, block.seed_id.to_numpy(), {c: block[c].to_numpy() for c in block.columns if c not in ("seed_id", "vector", "gate")}))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            seeds_, gates, ids, fields = shared.value
            for batch in batches:
                if not batch.num_rows or not len(ids):
                    continue
                rows = lambda c: unit(np.asarray(batch.column(c).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(batch.num_rows, -1))  # noqa: B023, E731
                s = seeds_ @ rows("vector").T
                s[~np.isfinite(s)] = -9
                if gates is not None:
                    s[~(np.round(gates @ rows("gate").T, DIGITS) > gate_floor)] = -9
                if keep:
                    good = keep({c: v[:, None] for c, v in fields.items()}, {c: batch.column(c).to_numpy(zero_copy_only=False)[None, :] for c in names})
                    s[~np.broadcast_to(good, s.shape)] = -9
                s = np.round(s, DIGITS)  # copies tie, whatever the order of their sums
                top = min(k, s.shape[1])
                least = -np.partition(-s, top - 1, axis=1)[:, top - 1 : top]
                i, j = np.nonzero((s >= least) & (s > max(floor, -8)))  # ties with the last one stay, the window decides by id
                other = batch.column("id").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(other[j]), pa.array(s[i, j])], names=["seed_id", "id", "similarity"])

        parts.append(corpus.mapInArrow(run, "seed_id bigint, id bigint, similarity double"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    rank = F.row_number().over(Window.partitionBy("seed_id").orderBy(F.desc("similarity"), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)
