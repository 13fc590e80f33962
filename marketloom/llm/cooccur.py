"""Items that appear together.

Method: blocked Gram matrix. Each task reads baskets in record blocks and writes a block as a binary sparse matrix (items by records, its
entries ordered by item). The items are cut into blocks of columns so that the product of one item block's transpose with the
record block has a bounded number of terms; the terms of a product are summed by sorting, and the sparse sums of all tasks are
added by one shuffle on the pair. The diagonal holds the marginals. Counts are then divided by what the marginals lead to expect.
Baskets are read and multiplied once: the summed matrix is checkpointed.

Defined results: an item is trimmed, loses its leading `$` signs and is put in upper case; null and blank items are dropped;
a repeated item counts once in its basket; a null, empty or all-blank basket is no record; an empty table gives no pairs;
further columns are ignored, whatever their names. A basket of m items costs m * m / 2 terms inside a product, not rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.session import checkpointed

RECORD_BLOCK = 4096
TERMS = 2_000_000  # terms of one product
FLUSH_PAIRS = 500_000
SUMS = "item_a string, item_b string, n bigint"


def basket(items: Column) -> Column:
    """The set of clean items of one record."""
    clean = F.transform(items, lambda x: F.upper(F.regexp_replace(F.regexp_replace(x, r"^[\s ]*\$*[\s ]*", ""), r"[\s ]+$", "")))
    return F.array_distinct(F.filter(clean, lambda x: x.isNotNull() & (x != "")))


def summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sums of their weights."""
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(weights, starts) if len(keys) else weights


class GramSums:
    """Sparse sums of transpose-products over record blocks; items are numbered as they come."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.records = 0

    def add(self, offsets: np.ndarray, names: pa.Array) -> None:
        """A record block: record r holds names[offsets[r]:offsets[r + 1]], all different."""
        coded = names.dictionary_encode()
        number = np.array([self.number.setdefault(x, len(self.number)) for x in coded.dictionary.to_pylist()], np.int64)
        lengths = np.diff(offsets)
        self.records += int((lengths > 0).sum())
        row = np.repeat(np.arange(len(lengths)), lengths)
        if not len(row):
            return
        col = number[coded.indices.to_numpy(zero_copy_only=False)]
        order = np.lexsort((col, row))  # the record block by rows, each row's items in order
        row, col = row[order], col[order]
        rest = np.repeat(offsets[1:], lengths) - np.arange(len(row))  # partners of an entry: itself and what follows in its row
        by_item = np.argsort(col, kind="stable")  # and by columns: the transpose
        ends = np.cumsum(rest[by_item])
        parts_k, parts_n = [self.keys], [self.counts]
        start = 0
        while start < len(by_item):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + TERMS, "right")))
            block = by_item[start:stop]  # an item block: as many columns as have a bounded product
            width = rest[block]
            left = np.repeat(block, width)
            right = left + np.arange(len(left)) - np.repeat(np.cumsum(width) - width, width)
            keys, counts = summed(col[left] << 32 | col[right], np.ones(len(left), np.int64))
            parts_k.append(keys), parts_n.append(counts)
            start = stop
        self.keys, self.counts = summed(np.concatenate(parts_k), np.concatenate(parts_n))

    def flush(self) -> pa.RecordBatch:
        names = np.array([*self.number, None], object)
        x, y = names[self.keys >> 32], names[self.keys & 0xFFFFFFFF]
        swap = np.array([a > b for a, b in zip(x, y)], bool)
        a, b = np.where(swap, y, x), np.where(swap, x, y)
        n = np.append(self.counts, self.records) if self.records else self.counts
        tail = [None] * (len(n) - len(a))
        self.__init__()
        return pa.RecordBatch.from_arrays([pa.array([*a, *tail], pa.string()), pa.array([*b, *tail], pa.string()), pa.array(n, pa.int64())], names=["item_a", "item_b", "n"])


def _gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = GramSums()
    for batch in batches:
        for start in range(0, batch.num_rows, RECORD_BLOCK):
            part = batch.column(0).slice(start, RECORD_BLOCK)
            offsets = part.offsets.to_numpy().astype(np.int64)
            sums.add(offsets - offsets[0], part.flatten())
            if len(sums.keys) > FLUSH_PAIRS:
                yield sums.flush()
    yield sums.flush()


def gram(df: DataFrame, *, items_col: str = "tickers") -> DataFrame:
    """(item_a, item_b, n) with item_a <= item_b: records with both; the row of nulls holds the number of records."""
    sums = df.select(basket(F.col(items_col)).alias("items")).filter(F.size("items") > 0).mapInArrow(_gram, SUMS)
    return sums.groupBy("item_a", "item_b").agg(F.sum("n").alias("n"))


def lifted_pairs(df: DataFrame, *, items_col: str = "tickers", min_count: int = 1, min_lift: float = 0.0) -> DataFrame:
    """(item_a, item_b, n_ab, n_a, n_b, n_records, lift) of pairs with item_a < item_b.

    The marginals have a row per distinct item; the adaptive planner broadcasts them only when they are measured to be small.
    """
    g = checkpointed(gram(df, items_col=items_col))
    single = g.filter(F.col("item_a") == F.col("item_b"))
    a, b = single.select("item_a", F.col("n").alias("n_a")), single.select("item_b", F.col("n").alias("n_b"))
    total = g.filter(F.col("item_a").isNull()).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_records"))
    both = g.filter(F.col("item_a") < F.col("item_b")).filter(F.col("n") >= min_count).withColumnRenamed("n", "n_ab")
    joined = both.join(a, "item_a").join(b, "item_b").crossJoin(F.broadcast(total))  # one row
    lift = F.col("n_ab") * F.col("n_records") / (F.col("n_a") * F.col("n_b"))
    kept = joined.filter((F.col("n_ab") * F.col("n_records")).cast("double") >= F.lit(float(min_lift)) * F.col("n_a") * F.col("n_b"))
    return kept.select("item_a", "item_b", "n_ab", "n_a", "n_b", "n_records", lift.alias("lift"))
