"""Most similar vectors for every vector.

Method: a hierarchical k-means tree, fitted on bounded samples that grow with its number of leaves (`PER_LEAF` vectors a leaf): a small
tree on the driver, a large one by its first level on the driver and each subtree on an executor from its own share of the sample. The
tree is broadcast, at most `MAX_TREE_BYTES` of centres. Every vector is indexed in the leaf it descends to. A query walks the tree best bin first: a priority queue
holds, for each node it has opened, the best child not yet taken; the child with the highest cosine to its centre is taken next, so
only opened nodes are ever compared. How many leaves are visited is calibrated: for a sample of queries the true neighbours are found
by brute force over all rows, and visits are widened until `target_recall` of them lie in visited leaves; what that gives on other queries
is measured and returned (`calibrated`, `Index.recall`).

Rows meet by a shuffle on the bin: leaves of one parent together, so that a query that visits several of them travels once. A bin
with many members or many askers is cut into blocks of both, by a hash of the id; each block of members meets each block of askers,
so nothing is dropped where a leaf is crowded, and a task that runs again makes the same blocks.

Copies: of vectors with equal bits that occur more than `HOT_COPIES` times (at most `MAX_HOT` of them, broadcast) only the copy with the smallest id is searched, and the result is expanded to the
others; a copy's partners are the copies with the smallest ids first. So a group of copies of any size costs its own rows.

Defined results: null, empty and all-zero vectors, and those with a null, infinite or NaN number or another length than most rows,
are in no pair; vectors need not have length 1; ties in similarity go to the smaller id (equal within 9 digits counts as a tie); an id that occurs twice with different vectors keeps
both as partners, but never pairs with itself; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.session import checkpointed

SAMPLE = 20_000  # vectors of a fit on the driver, at most about so many
PER_LEAF = 20  # vectors of the sample for each leaf
CALIBRATION = 1000  # queries of the calibration, half of them to measure, at most about so many
BRANCHING = 16
FANS = 64  # children of the root of a large tree
LEAF_ROWS = 1000
MAX_TREE_BYTES = 64 << 20
BIN_ROWS = 16_000
ASK_ROWS = 32_000
HOT_COPIES = 1000
MAX_HOT = 10_000
EPS = 2e-6  # of a cosine in float32


@dataclass
class Tree:
    """Node i's children are first[i] .. first[i] + count[i]; a leaf has count 0 and number leaf[i]; the first `roots` nodes are the root's children."""

    centres: np.ndarray
    first: np.ndarray
    count: np.ndarray
    leaf: np.ndarray
    roots: int

    @property
    def leaves(self) -> int:
        return int((self.count == 0).sum())

    def parents(self) -> np.ndarray:
        """The parent of each leaf, -1 for the root."""
        parent = np.full(len(self.count), -1, np.int64)
        inner = np.flatnonzero(self.count)
        parent[np.repeat(self.first[inner], self.count[inner]) + np.arange(self.count[inner].sum()) - np.repeat(np.cumsum(self.count[inner]) - self.count[inner], self.count[inner])] = np.repeat(inner, self.count[inner])
        out = np.empty(self.leaves, np.int64)
        out[self.leaf[self.count == 0]] = parent[self.count == 0]
        return out

    def visit(self, vectors: np.ndarray, visits: int) -> np.ndarray:
        """Leaf numbers in best-bin-first order, (rows, visits); -1 where the tree has fewer leaves."""
        step = int(np.clip(2_000_000 // max(1, int(self.count.max(initial=1)) * vectors.shape[1]), 16, 2048)) if len(vectors) else 1
        parts = [self._visit(vectors[s : s + step], visits) for s in range(0, len(vectors), step)]
        return np.concatenate(parts) if parts else np.zeros((0, visits), np.int32)

    def _visit(self, vectors: np.ndarray, visits: int) -> np.ndarray:
        rows, width = len(vectors), int(max(self.roots, self.count.max(initial=0)))
        # the priority queue: per opened node its children in order of their cosine, how far they are taken, and the cosine of the next one
        value, node = np.full((rows, 4, width), -np.inf, np.float32), np.zeros((rows, 4, width), np.int32)
        taken, head, opened = np.zeros((rows, 4), np.int64), np.full((rows, 4), -np.inf, np.float32), np.ones(rows, np.int64)
        first = vectors @ self.centres[: self.roots].T
        order = np.argsort(-first, axis=1, kind="stable")
        value[:, 0, : self.roots], node[:, 0, : self.roots] = np.take_along_axis(first, order, 1), order
        head[:, 0] = value[:, 0, 0]
        out, filled, busy = np.full((rows, visits), -1, np.int32), np.zeros(rows, np.int64), np.arange(rows)
        place = np.arange(width)
        while len(busy):
            best = head[busy].argmax(1)
            alive = head[busy, best] > -np.inf
            busy, best = busy[alive], best[alive]
            at = taken[busy, best]
            now = node[busy, best, at]
            taken[busy, best] = at + 1
            head[busy, best] = np.where(at + 1 < width, value[busy, best, np.minimum(at + 1, width - 1)], -np.inf)
            ends = self.count[now] == 0
            hit = busy[ends]
            out[hit, filled[hit]] = self.leaf[now[ends]]
            filled[hit] += 1
            who, inner = busy[~ends], now[~ends]
            if len(who):
                if opened[who].max() == head.shape[1]:
                    grow = head.shape[1]
                    value, node = np.concatenate([value, np.full((rows, grow, width), -np.inf, np.float32)], 1), np.concatenate([node, np.zeros((rows, grow, width), np.int32)], 1)
                    taken, head = np.concatenate([taken, np.zeros((rows, grow), np.int64)], 1), np.concatenate([head, np.full((rows, grow), -np.inf, np.float32)], 1)
                valid = place < self.count[inner][:, None]
                children = np.where(valid, self.first[inner][:, None] + place, 0)
                cosine = np.where(valid, np.einsum("rd,rkd->rk", vectors[who], self.centres[children]), -np.inf)
                order = np.argsort(-cosine, axis=1, kind="stable")
                slot = opened[who]
                value[who, slot], node[who, slot] = np.take_along_axis(cosine, order, 1), np.take_along_axis(children, order, 1)
                head[who, slot] = value[who, slot, 0]
                opened[who] += 1
            busy = busy[filled[busy] < visits]
        return out


def _kmeans(vectors: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    centres = vectors[rng.choice(len(vectors), k, replace=False)]
    for _ in range(rounds):
        nearest = (vectors @ centres.T).argmax(1)
        order = np.argsort(nearest, kind="stable")
        present, starts = np.unique(nearest[order], return_index=True)
        sums = np.zeros_like(centres)
        sums[present] = np.add.reduceat(vectors[order], starts, axis=0)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 0, sums / np.maximum(length, 1e-12), centres)
    return centres, (vectors @ centres.T).argmax(1)


def _tree(centres: np.ndarray, first: np.ndarray, count: np.ndarray, roots: int) -> Tree:
    number = np.full(len(count), -1, np.int32)
    number[count == 0] = np.arange((count == 0).sum())
    return Tree(np.asarray(centres, np.float32), np.asarray(first, np.int64), np.asarray(count, np.int64), number, roots)


def fit_tree(sample: np.ndarray, leaves: int, branching: int = BRANCHING, seed: int = 7) -> Tree:
    """Hierarchical spherical k-means with about `leaves` leaves; a node is split as long as its share of the sample has two vectors for each leaf below it."""
    rng = np.random.default_rng(seed)
    dim = sample.shape[1] if sample.size else 1
    centres, first, count = [], [], []
    # level by level, so that a node's children lie together
    level = [(None, sample, max(1, leaves))]
    roots = 0
    while level:
        following = []
        for parent, members, share in level:
            k = min(branching, share, len(members))
            if parent is not None and k < 2:
                continue
            if k < 2:
                c, nearest = (members.mean(0, keepdims=True) if len(members) else np.zeros((1, dim), np.float32)), np.zeros(len(members), np.int64)
            else:
                c, nearest = _kmeans(members, k, rng)
            start = len(centres)
            if parent is None:
                roots = len(c)
            else:
                first[parent], count[parent] = start, len(c)
            for j in range(len(c)):
                centres.append(c[j]), first.append(0), count.append(0)
                own = members[nearest == j]
                below = round(share * len(own) / max(1, len(members)))
                if below > 1 and 2 * below < len(own) < len(members):  # equal vectors cannot be split
                    following.append((start + j, own, below))
        level = following
    return _tree(np.array(centres), np.array(first), np.array(count), roots)


def fit_large_tree(units: DataFrame, total: int, leaves: int) -> Tree:
    """The tree of many leaves: its first level from a sample on the driver, each subtree on an executor from the `PER_LEAF` vectors a leaf that fall to it."""
    root = fit_tree(_stacked(units.filter(_about(SAMPLE, total, 1)).select("v").toPandas().v), FANS, branching=FANS)
    centres = units.sparkSession.sparkContext.broadcast(root.centres)
    wanted = PER_LEAF * leaves

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array((_matrix(batch.column(0)) @ centres.value.T).argmax(1), pa.int32()), batch.column(0)], names=["fan", "v"])

    def grown(group: pa.Table) -> pa.Table:
        m = _matrix(group.column("v"))
        sub = fit_tree(m, max(1, round(leaves * len(m) / max(1, min(wanted, total)))))
        return pa.table({"fan": group.column("fan")[:1], "centres": pa.array([sub.centres.ravel()], pa.list_(pa.float32())), "first": pa.array([sub.first], pa.list_(pa.int32())), "count": pa.array([sub.count], pa.list_(pa.int32())), "roots": pa.array([sub.roots], pa.int32())})

    parts = units.filter(_about(wanted, total, 4)).select("v").mapInArrow(sent, "fan int, v array<float>").groupBy("fan").applyInArrow(grown, "fan int, centres array<float>, first array<int>, count array<int>, roots int").collect()
    c, first, count, base = [root.centres], np.zeros(len(root.centres), np.int64), np.zeros(len(root.centres), np.int64), len(root.centres)
    for p in sorted(parts, key=lambda p: p.fan):
        if p.roots < 2:
            continue
        sub_first, sub_count = np.array(p["first"], np.int64), np.array(p["count"], np.int64)
        first[p.fan], count[p.fan] = base, p.roots
        c.append(np.array(p.centres, np.float32).reshape(len(sub_count), -1))
        first, count = np.concatenate([first, np.where(sub_count > 0, sub_first + base, 0)]), np.concatenate([count, sub_count])
        base += len(sub_count)
    return _tree(np.concatenate(c), first, count, len(root.centres))


def _stacked(vectors) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float32) if len(vectors) else np.zeros((0, 1), np.float32)


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float32).reshape(len(column), -1)


def unit_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v, h): usable vectors at length 1 and a hash of the stored numbers."""
    raw = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<float>").alias("x"), F.xxhash64(F.col(vector_col)).alias("h")).filter(F.col("id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            lengths = np.diff(column.offsets.to_numpy())
            flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float32)
            for width in np.unique(lengths):
                rows = np.flatnonzero(lengths == width)
                m = flat.reshape(-1, width) if len(rows) == len(lengths) else np.stack([flat[s : s + width] for s in (column.offsets.to_numpy() - column.offsets.to_numpy()[0])[rows]])
                size = np.sqrt((m.astype(np.float64) ** 2).sum(1))
                good = np.isfinite(size) & (size > 0)
                unit = (m[good] / size[good, None]).astype(np.float32)
                offsets = pa.array(np.arange(0, len(unit) * width + 1, width, dtype=np.int32))
                keep = pa.array(rows[good])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), pa.ListArray.from_arrays(offsets, pa.array(unit.ravel())), batch.column(2).take(keep)], names=["id", "v", "h"])

    return raw.mapInArrow(run, f"id {raw.schema['id'].dataType.simpleString()}, v array<float>, h bigint")


def _about(rows: int, total: int, seed: int) -> Column:
    """A filter that keeps about `rows` of `total` rows, by a hash of the id."""
    share = min(1.0, rows / max(total, 1))
    return F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 24)) < F.lit(math.ceil(share * (1 << 24)))


def brute_force(queries: np.ndarray, numbers: list, rows: DataFrame, k: int, min_similarity: float, tree: Tree) -> DataFrame:
    """(q, id, similarity, leaf): each query's k most similar of all rows and the leaves they are in, partial lists first; the queries are a bounded block."""
    shared = rows.sparkSession.sparkContext.broadcast((queries, np.array(numbers), tree))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, own, walk = shared.value
        for batch in batches:
            ids, m = batch.column(0).to_numpy(zero_copy_only=False), _matrix(batch.column(1))
            s = q @ m.T
            s[own[:, None] == ids[None, :]] = -2
            top = min(k, s.shape[1])
            at = np.argpartition(-s, top - 1, axis=1)[:, :top]
            value = np.take_along_axis(s, at, 1)
            i, j = np.nonzero(value >= max(min_similarity, -1.5))
            found, back = np.unique(at[i, j], return_inverse=True)
            home = walk.visit(m[found], 1)[:, 0][back] if len(found) else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(own[i]), pa.array(ids[at[i, j]]), pa.array(value[i, j]), pa.array(home, pa.int32())], names=["q", "id", "similarity", "leaf"])

    kind = rows.schema["id"].dataType.simpleString()
    found = rows.select("id", "v").mapInArrow(run, f"q {kind}, id {kind}, similarity float, leaf int")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("similarity"), "id"))
    return found.withColumn("r", rank).filter(F.col("r") <= k).drop("r")


def widened_visits(tree: Tree, queries: np.ndarray, wanted: list[tuple[int, int]], target_recall: float) -> int:
    """Fewest leaf visits under which `target_recall` of the wanted (query, leaf) lie in visited leaves; visits are doubled until they are enough."""
    visits, need = 4, math.ceil(target_recall * len(wanted))
    at, leaf = (np.array(x, np.int64) for x in zip(*wanted))
    while True:
        visits = min(visits, tree.leaves)
        hits = tree.visit(queries, visits)[at] == leaf[:, None]
        ranks = np.sort(np.where(hits.any(1), hits.argmax(1) + 1, tree.leaves + 1))
        if ranks[need - 1] <= visits or visits == tree.leaves:
            return int(min(ranks[need - 1], tree.leaves))
        visits *= 2


@dataclass
class Index:
    """A tree with its calibrated number of visits, and the recall they reached on queries that took no part in the calibration (1 where there was nothing to find)."""

    tree: Tree
    visits: int
    recall: float
    queries: int
    rows: int


def calibrated(reps: DataFrame, total: int, width: int, *, k: int, min_similarity: float, target_recall: float, wanted: Column) -> Index:
    """The index of all rows. Queries and their true neighbours are drawn from the rows that are searched, so copies don't flatter the recall."""
    leaves = int(max(1, min(total // LEAF_ROWS, MAX_TREE_BYTES // (4 * width + 24))))
    if leaves * PER_LEAF > SAMPLE:
        tree = fit_large_tree(reps, total, leaves)
    else:
        tree = fit_tree(_stacked(reps.filter(_about(SAMPLE, total, 1)).select("v").toPandas().v), leaves)
    if tree.leaves == 1:
        return Index(tree, 1, 1.0, 0, total)
    part = reps.filter(wanted)
    probe = part.filter(_about(CALIBRATION, part.count(), 2)).select("id", "v").toPandas().drop_duplicates("id").sort_values("id")
    if not len(probe):
        return Index(tree, tree.leaves, 1.0, 0, total)
    q, numbers = _stacked(probe.v), probe.id.tolist()
    row = {x: i for i, x in enumerate(numbers)}
    truth = [(row[t.q], t.leaf) for t in brute_force(q, numbers, reps, k, min_similarity, tree).collect()]  # at most k rows per calibration query
    half, other = [t for t in truth if t[0] % 2 == 0], [t for t in truth if t[0] % 2]
    if not half or not other:
        half = other = truth
    visits = widened_visits(tree, q, half, target_recall) if truth else 1
    order = tree.visit(q, visits)
    reached = float(np.mean([leaf in order[i] for i, leaf in other])) if other else 1.0
    return Index(tree, visits, reached, len(numbers), total)


@dataclass
class Prepared:
    """Unit vectors, written once, what of them is searched, and the copies left out of the search."""

    units: DataFrame
    reps: DataFrame
    hot: DataFrame | None
    total: int
    width: int


def prepared(df: DataFrame, id_col: str, vector_col: str) -> Prepared | None:
    units = checkpointed(unit_vectors(df, id_col, vector_col))
    sizes = units.groupBy(F.size("v").alias("width")).count().collect()  # a row per length of vector
    if not sizes:
        return None
    total, width = max((r["count"], r["width"]) for r in sizes)
    units = units.filter(F.size("v") == width)
    least = max(HOT_COPIES, total // MAX_HOT)
    classes = checkpointed(units.groupBy("h").agg(F.min("id").alias("rep"), F.count("*").alias("n")).filter(F.col("n") > least).select("h", "rep"))  # at most MAX_HOT rows
    if classes.isEmpty():
        return Prepared(units, units, None, total, width)
    reps = units.join(F.broadcast(classes), "h", "left").filter(F.col("rep").isNull() | (F.col("rep") == F.col("id"))).dropDuplicates(["h", "id"]).select("id", "v", "h")
    return Prepared(units, checkpointed(reps), classes, total, width)


def index_of(df: DataFrame, *, k: int = 5, min_similarity: float = -1.0, target_recall: float = 0.98, id_col: str = "id", vector_col: str = "embedding", queries: Column | None = None) -> Index | None:
    """The calibrated index of a table, with the recall measured for it."""
    p = prepared(df, id_col, vector_col)
    return p and calibrated(p.reps, p.total, p.width, k=k, min_similarity=min_similarity, target_recall=target_recall, wanted=queries if queries is not None else F.lit(True))


def most_similar(df: DataFrame, *, k: int = 5, min_similarity: float = -1.0, target_recall: float = 0.98, id_col: str = "id", vector_col: str = "embedding", queries: Column | None = None) -> DataFrame:
    """(id, other_id, similarity): for each row (or each that `queries`, a condition on `id`, selects) its k most similar others."""
    kind = df.schema[id_col].dataType.simpleString()
    p = prepared(df, id_col, vector_col)
    if p is None:
        return df.sparkSession.createDataFrame([], f"id {kind}, other_id {kind}, similarity double")
    wanted = queries if queries is not None else F.lit(True)
    index = calibrated(p.reps, p.total, p.width, k=k, min_similarity=min_similarity, target_recall=target_recall, wanted=wanted)
    asking = p.reps.withColumn("asks", wanted)
    if p.hot is not None and queries is not None:  # a group of copies asks when any of them does
        groups = p.units.filter(wanted).join(F.broadcast(p.hot.select("h")), "h", "left_semi").select("h").distinct().withColumn("c", F.lit(True))
        asking = p.reps.join(F.broadcast(groups), "h", "left").withColumn("asks", wanted | F.coalesce("c", F.lit(False)))
    found = _search(asking, index, k, min_similarity)
    return found if p.hot is None else _with_copies(found, p.units, p.hot, k, wanted)


def _bins(tree: Tree, counts: np.ndarray, width: int, asks: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each leaf its bin; of each bin its number of blocks of members and of askers. `asks` is the number of visits to a row's leaf, on average."""
    most = int(np.clip(8_000_000 // width, 1000, BIN_ROWS))
    parent, of, rows = tree.parents(), np.zeros(tree.leaves, np.int64), []
    for leaf in np.lexsort((np.arange(tree.leaves), parent)).tolist():
        if rows and parent[leaf] == last and rows[-1] + counts[leaf] <= most:
            rows[-1] += int(counts[leaf])
        else:
            rows.append(int(counts[leaf]))
        of[leaf], last = len(rows) - 1, parent[leaf]
    n = np.array(rows)
    return of, np.maximum(1, np.ceil(n / most).astype(np.int64)), np.maximum(1, np.ceil(n * asks / (2 * most)).astype(np.int64))


def _search(asking: DataFrame, index: Index, k: int, min_similarity: float) -> DataFrame:
    """Top-k of each asking row among all rows: (id, other_id, similarity)."""
    spark, tree, visits = asking.sparkSession, index.tree, index.visits
    shared = spark.sparkContext.broadcast(tree)
    kind = asking.schema["id"].dataType.simpleString()

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, n = np.unique(shared.value.visit(_matrix(batch.column(0)), 1)[:, 0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int32()), pa.array(n, pa.int64())], names=["leaf", "n"])

    counts = np.zeros(tree.leaves, np.int64)
    for r in asking.select("v").mapInArrow(homes, "leaf int, n bigint").groupBy("leaf").agg(F.sum("n").alias("n")).collect():  # a row per leaf
        counts[r.leaf] = r.n
    askers = asking.filter("asks").count()
    cut = spark.sparkContext.broadcast(_bins(tree, counts, tree.centres.shape[1], visits * askers / max(1, index.rows)))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, members, asked = cut.value
        for whole in batches:
            for start in range(0, whole.num_rows, 2048):
                batch = whole.slice(start, 2048)
                m, asks, salt = _matrix(batch.column(1)), batch.column(2).to_numpy(zero_copy_only=False).astype(bool), batch.column(3).to_numpy().view(np.uint64)
                order = np.full((len(m), visits), -1, np.int32)
                if asks.any():
                    order[asks] = shared.value.visit(m[asks], visits)
                if not asks.all():
                    order[~asks, :1] = shared.value.visit(m[~asks], 1)
                home = order[:, 0]
                # visits of askers by (row, bin): the leaves to be searched there
                row, turn = np.nonzero((order >= 0) & asks[:, None])
                leaf = order[row, turn]
                by = np.lexsort((leaf, of[leaf], row))
                row, leaf = row[by], leaf[by]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (of[leaf][1:] != of[leaf][:-1])
                starts = np.append(np.flatnonzero(new), len(row))
                who, where = row[starts[:-1]], of[leaf[starts[:-1]]]
                # an asker meets every block of members, a member every block of askers
                times = members[where]
                pair = np.repeat(np.arange(len(who)), times)
                block = np.arange(len(pair)) - np.repeat(np.cumsum(times) - times, times)
                mine = asked[of[home]]
                own = np.repeat(np.arange(len(m)), mine)
                turn = np.arange(len(own)) - np.repeat(np.cumsum(mine) - mine, mine)
                mod = lambda x, n: ((x >> np.uint64(17)) % n.astype(np.uint64)).astype(np.int64)
                cells = np.concatenate([
                    np.stack([who[pair], where[pair], block, mod(salt[who[pair]] * np.uint64(0x9E3779B97F4A7C15), asked[where[pair]])], 1),
                    np.stack([own, of[home[own]], mod(salt[own], members[of[home[own]]]), turn], 1),
                ])
                asks_at, home_at = np.concatenate([pair, np.full(len(own), -1)]), np.concatenate([np.full(len(pair), -1), home[own]])
                cells, back = np.unique(cells, axis=0, return_inverse=True)
                asks_of, home_of = np.full(len(cells), -1, np.int64), np.full(len(cells), -1, np.int64)
                np.maximum.at(asks_of, back.ravel(), asks_at), np.maximum.at(home_of, back.ravel(), home_at)
                lengths = np.where(asks_of >= 0, (starts[1:] - starts[:-1])[asks_of] if len(who) else 0, 0)
                listed = np.repeat(starts[asks_of] if len(who) else np.zeros(len(cells), np.int64), lengths) + np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                leaves = leaf[listed].astype(np.int32) if len(listed) else np.zeros(0, np.int32)
                ends = np.concatenate([[0], np.cumsum(lengths)])
                for s in range(0, len(cells), 8192):
                    piece = slice(s, s + 8192)
                    c = cells[piece]
                    lists = pa.ListArray.from_arrays(pa.array(ends[s : s + len(c) + 1] - ends[s], pa.int32()), pa.array(leaves[ends[s] : ends[s + len(c)]]))
                    vectors = pa.ListArray.from_arrays(pa.array(np.arange(0, len(c) * m.shape[1] + 1, m.shape[1], dtype=np.int32)), pa.array(m[c[:, 0]].ravel()))
                    ints = lambda x: pa.array(x.astype(np.int32))
                    yield pa.RecordBatch.from_arrays([ints(c[:, 1]), ints(c[:, 2]), ints(c[:, 3]), batch.column(0).take(pa.array(c[:, 0])), ints(home_of[piece]), lists, vectors], names=["bin", "block", "turn", "id", "home", "asks", "v"])

    def meet(group: pa.Table) -> pa.Table:
        ids, home = group.column("id").to_numpy(), group.column("home").to_numpy()
        m, lists = _matrix(group.column("v")), group.column("asks").combine_chunks()
        lengths = np.diff(lists.offsets.to_numpy())
        asker, leaf = np.repeat(np.arange(len(ids)), lengths), lists.flatten().to_numpy()
        out_q, out_i, out_s = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        for number in np.unique(leaf):
            inside, rows_ = np.flatnonzero(home == number), asker[leaf == number]
            if not len(inside):
                continue
            target = m[inside].T.copy()
            for s in range(0, len(rows_), 1024):
                rows = rows_[s : s + 1024]
                sims = m[rows] @ target
                sims[ids[rows][:, None] == ids[inside][None, :]] = -2
                near = (sims >= min_similarity - EPS) & (sims > -1.5)
                crowded = np.flatnonzero(near.sum(1) > k)  # of many near ones only the nearest go on, with those that may tie with the last of them
                if len(crowded):
                    least = -np.partition(-sims[crowded], k - 1, axis=1)[:, k - 1 : k]
                    near[crowded] &= sims[crowded] >= least - EPS
                i, j = np.nonzero(near)
                exact = np.round(np.einsum("ij,ij->i", m[rows[i]].astype(np.float64), m[inside[j]].astype(np.float64)), 9)
                good = exact >= min_similarity
                out_q.append(rows[i][good]), out_i.append(inside[j][good]), out_s.append(exact[good])
        q, i, sim = np.concatenate(out_q), np.concatenate(out_i), np.concatenate(out_s)
        order = np.lexsort((ids[i], -sim, q))  # each asker's best of the whole bin
        q, i, sim = q[order], i[order], sim[order]
        here = np.arange(len(q))
        begins = np.concatenate([[True], q[1:] != q[:-1]]) if len(q) else np.zeros(0, bool)
        kept = here - np.maximum.accumulate(np.where(begins, here, 0)) < k if len(q) else here
        q, i, sim = q[kept], i[kept], sim[kept]
        return pa.table({"id": group.column("id").combine_chunks().take(pa.array(q)), "other_id": group.column("id").combine_chunks().take(pa.array(i)), "similarity": pa.array(sim, pa.float64())})

    met = asking.select("id", "v", "asks", F.xxhash64("id", "h").alias("salt")).mapInArrow(spread, f"bin int, block int, turn int, id {kind}, home int, asks array<int>, v array<float>").groupBy("bin", "block", "turn").applyInArrow(meet, f"id {kind}, other_id {kind}, similarity double")
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("similarity"), "other_id"))
    return met.withColumn("r", rank).filter(F.col("r") <= k).drop("r")


def _with_copies(found: DataFrame, units: DataFrame, hot: DataFrame, k: int, wanted: Column) -> DataFrame:
    """The result of the representatives, expanded to copies of the hot vectors; what is joined with all rows is broadcast, at most `MAX_HOT` rows or k + 1 times as many."""
    in_class = units.select("h", F.col("id").alias("copy")).join(F.broadcast(hot), "h")
    rank = F.row_number().over(Window.partitionBy("h").orderBy("copy"))  # ranked within each task before the shuffle
    few = checkpointed(in_class.withColumn("r", rank).filter(F.col("r") <= k + 1).select("h", "rep", "copy"))
    asking = in_class.select("h", "rep", F.col("copy").alias("asker"))
    others = few.select(F.col("rep").alias("other_id"), F.col("copy").alias("other_copy"))
    wide = found.join(F.broadcast(others), "other_id", "left").select("id", F.coalesce("other_copy", "other_id").alias("other_id"), "similarity")
    plain = wide.join(F.broadcast(hot.select(F.col("rep").alias("id"))), "id", "left_anti")
    of_hot = wide.join(F.broadcast(hot.select(F.col("rep").alias("id"))), "id", "left_semi")  # at most MAX_HOT representatives with k partners, or k * (k + 1) copies
    moved = asking.join(F.broadcast(of_hot.withColumnRenamed("id", "rep")), "rep").select(F.col("asker").alias("id"), "other_id", "similarity")
    own = asking.join(F.broadcast(few.select("h", "copy")), "h").filter(F.col("asker") != F.col("copy")).select(F.col("asker").alias("id"), F.col("copy").alias("other_id"), F.lit(1.0).alias("similarity"))
    last = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("similarity"), "other_id"))
    every = plain.unionByName(moved).unionByName(own)
    return every.filter(wanted & (F.col("id") != F.col("other_id"))).withColumn("r", last).filter(F.col("r") <= k).drop("r")


def close_pairs(df: DataFrame, *, min_similarity: float, k: int = 5, target_recall: float = 0.99, id_col: str = "id", vector_col: str = "embedding") -> DataFrame:
    """(id_a, id_b), id_a < id_b: rows of at least `min_similarity`, one of them among the other's k most similar."""
    near = most_similar(df, k=k, min_similarity=min_similarity, target_recall=target_recall, id_col=id_col, vector_col=vector_col)
    return near.select(F.least("id", "other_id").alias("id_a"), F.greatest("id", "other_id").alias("id_b")).distinct()
