from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.llm import similar

SCHEMA = "id bigint, embedding array<float>, v string, h int"


def planted(n: int, groups: int, seed: int = 1) -> np.ndarray:
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 24))
    for g in range(groups):
        x[4 * g + 1 : 4 * g + 4] = x[4 * g] + rng.normal(size=(3, 24)) * 0.15
    return x.astype(np.float32) * rng.uniform(0.3, 3, (n, 1)).astype(np.float32)


def truth(x: np.ndarray, k: int, least: float) -> set[tuple[int, int]]:
    u = x.astype(np.float64) / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    return {(i, int(j)) for i in range(len(x)) for j in np.argsort(-s[i], kind="stable")[:k] if s[i, j] >= least}


def test_close_pairs_and_recall(spark, monkeypatch):
    monkeypatch.setattr(similar, "LEAF_ROWS", 40)
    x = planted(1200, 60)
    df = spark.createDataFrame([(i, v.tolist(), "", 0) for i, v in enumerate(x)], SCHEMA)
    got = {(r.id_a, r.id_b) for r in similar.close_pairs(df, min_similarity=0.85).collect()}
    want = {(min(p), max(p)) for p in truth(x, 5, 0.85)}
    assert got <= want and len(got) >= 0.97 * len(want)
    near = {(r.id, r.other_id) for r in similar.most_similar(df, k=5, target_recall=0.95, queries=F.col("id") % 10 == 0).collect()}
    exact = {p for p in truth(x, 5, -1) if p[0] % 10 == 0}
    assert len(near) == len(exact) and len(near & exact) >= 0.9 * len(exact)


def test_crowded_leaves_are_cut_without_loss(spark, monkeypatch):
    monkeypatch.setattr(similar, "LEAF_ROWS", 300)
    monkeypatch.setattr(similar, "_bins", lambda tree, counts, width, asks: (np.arange(tree.leaves), np.maximum(1, -(-counts // 25)), np.full(tree.leaves, 3)))
    x = planted(400, 40, 2)
    df = spark.createDataFrame([(i, v.tolist(), "", 0) for i, v in enumerate(x)], SCHEMA)
    got = {(r.id_a, r.id_b) for r in similar.close_pairs(df, min_similarity=0.85, target_recall=1.0).collect()}
    assert got == {(min(p), max(p)) for p in truth(x, 5, 0.85)}


def test_copies_ties_and_unusable_vectors(spark):
    rows = [(i, [1.0, 0.0], "", 0) for i in range(9)] + [(20, [0.0, 1.0], "", 0), (21, [0.1, 1.0], "", 0)]
    rows += [(30, None, "", 0), (31, [], "", 0), (32, [0.0, 0.0], "", 0), (33, [float("nan"), 1.0], "", 0), (34, [1.0, None], "", 0), (35, [1.0], "", 0), (36, [float("inf"), 1.0], "", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    near = {}
    for r in similar.most_similar(df, k=3, min_similarity=0.9).collect():
        near.setdefault(r.id, []).append(r.other_id)
    assert sorted(near[0]) == [1, 2, 3] and sorted(near[1]) == [0, 2, 3] and sorted(near[8]) == [0, 1, 2]
    assert near[20] == [21] and near[21] == [20] and not set(near) & set(range(30, 40))


@pytest.mark.parametrize("rows", [[], [(1, None, "", 0)], [(1, [1.0, 2.0], "", 0)]])
def test_tables_without_pairs(spark, rows):
    assert similar.most_similar(spark.createDataFrame(rows, SCHEMA), k=3).count() == 0


def test_best_bin_first_visits_every_leaf_once():
    x = planted(500, 10)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    tree = similar.fit_tree(u, 40)
    order = tree.visit(u[:50], tree.leaves)
    assert all(sorted(row) == list(range(tree.leaves)) for row in order.tolist())
    assert (tree.visit(u[:50], 1)[:, 0] == order[:, 0]).all()


def test_a_third_of_equal_vectors_and_a_dense_cluster(spark, monkeypatch):
    monkeypatch.setattr(similar, "LEAF_ROWS", 30)
    monkeypatch.setattr(similar, "HOT_COPIES", 50)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 24)).astype(np.float32)
    x[:200] = x[0]
    x[200:260] = x[0] + rng.normal(size=(60, 24)) * 0.02
    df = spark.createDataFrame([(i, v.tolist(), "", 0) for i, v in enumerate(x)], SCHEMA)
    near = {}
    for r in similar.most_similar(df, k=5, min_similarity=0.85, target_recall=1.0).collect():
        near.setdefault(r.id, set()).add(r.other_id)
    assert near[0] == {1, 2, 3, 4, 5} and near[150] == {0, 1, 2, 3, 4}
    want = {}
    for a, b in truth(x, 5, 0.85):
        want.setdefault(a, set()).add(b)
    hits = sum(len(near.get(a, set()) & want[a]) for a in range(200, 600) if a in want)
    assert hits >= 0.95 * sum(len(want[a]) for a in range(200, 600) if a in want)


def test_a_large_tree_has_the_leaves_it_was_asked_for():
    """The sample grows with the leaves, so many leaves are not fewer than asked by much."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(similar.PER_LEAF * 4096, 16)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert 0.8 * 4096 < similar.fit_tree(x, 4096).leaves < 1.2 * 4096


def test_subtrees_are_fitted_on_executors(spark, monkeypatch):
    monkeypatch.setattr(similar, "SAMPLE", 2000)
    monkeypatch.setattr(similar, "LEAF_ROWS", 20)
    x = planted(6000, 200, 5)
    df = spark.createDataFrame([(i, v.tolist(), "", 0) for i, v in enumerate(x)], SCHEMA).repartition(4)
    p = similar.prepared(df, "id", "embedding")
    tree = similar.fit_large_tree(p.reps, p.total, 300)
    assert 0.7 * 300 < tree.leaves < 1.4 * 300
    order = tree.visit(x[:20] / np.linalg.norm(x[:20], axis=1, keepdims=True), tree.leaves)
    assert all(sorted(row) == list(range(tree.leaves)) for row in order.tolist())
    got = {(r.id_a, r.id_b) for r in similar.close_pairs(df, min_similarity=0.85).collect()}
    want = {(min(p), max(p)) for p in truth(x, 5, 0.85)}
    assert got <= want and len(got) >= 0.97 * len(want)


def test_the_queue_takes_the_best_open_child_first():
    x = planted(3000, 10, 6)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    tree = similar.fit_tree(u, 150)
    import heapq

    for v, got in zip(u[:15], tree.visit(u[:15], 20)):
        heap = [(-float(v @ tree.centres[i]), i) for i in range(tree.roots)]
        heapq.heapify(heap)
        want = []
        while heap and len(want) < 20:
            _, i = heapq.heappop(heap)
            if tree.count[i]:
                for j in range(tree.first[i], tree.first[i] + tree.count[i]):
                    heapq.heappush(heap, (-float(v @ tree.centres[j]), j))
            else:
                want.append(int(tree.leaf[i]))
        assert got.tolist() == want


def test_measured_recall(spark, monkeypatch):
    monkeypatch.setattr(similar, "LEAF_ROWS", 40)
    x = planted(1500, 60, 8)
    df = spark.createDataFrame([(i, v.tolist(), "", 0) for i, v in enumerate(x)], SCHEMA)
    index = similar.index_of(df, k=5, target_recall=0.9)
    assert index.recall > 0.8 and 1 <= index.visits <= index.tree.leaves and index.rows == 1500
