import random
from collections import Counter

import numpy as np
import pytest
from llm_tables import clashing
from pyspark.sql import functions as F

from clamor.llm import neighbours
from clamor.llm.neighbours import Tree, nearest_neighbours, nearest_of

VECTORS = "vec_id long, embedding array<float>, label int"


def table(spark, data, first_id=0):
    rows = [(first_id + k, None if x is None else [None if v is None else float(v) for v in x], 0) for k, x in enumerate(data)]
    return spark.createDataFrame(rows, VECTORS)


def brute(ids, data, queries, k):
    data, ids, want = np.asarray(data, np.float64), np.asarray(ids), {}
    for q in queries:
        at = int(np.flatnonzero(ids == q)[0])
        score = data @ data[at]
        others = np.flatnonzero(ids != q)
        order = others[np.lexsort((ids[others], -score[others]))][:k]
        want[q] = [int(i) for i in ids[order]]
    return want


def answers(frame):
    found = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append(r)
        assert r.rank == len(found[r.query_id])
    return found


def test_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LEAF", 40)
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 16))
    data = (centres[rng.integers(0, 30, 1500)] + 0.2 * rng.normal(size=(1500, 16))).astype(np.float32)
    found = answers(nearest_neighbours(table(spark, data), F.col("id") % 20 == 0))
    want = brute(range(1500), data, range(0, 1500, 20), 20)
    assert set(found) == set(want) and all(len(v) == 20 for v in found.values())
    hits = sum(len({r.vec_id for r in found[q]} & set(want[q])) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    for q, rows in found.items():
        for r in rows:
            exact = sum(float(a) * float(b) for a, b in zip(data[q], data[r.vec_id], strict=True))
            assert r.score == pytest.approx(exact, abs=1e-12)
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)


def test_full_recall_is_exact_with_many_copies(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LEAF", 10)
    rng = np.random.default_rng(2)
    data = rng.integers(-2, 3, (400, 4)).astype(np.float32)
    data[::3] = data[0] if data[0].any() else 1
    data[~data.any(axis=1)] = 1
    found = answers(nearest_neighbours(table(spark, data), F.col("id") % 20 == 0, k=7, recall=1.0))
    want = brute(range(400), data, range(0, 400, 20), 7)
    hits = sum(len({r.vec_id for r in found[q]} & set(want[q])) for q in want)
    assert hits == 7 * len(want) or hits >= 0.99 * 7 * len(want)
    hot = [q for q in want if (data[q] == data[0]).all()]
    assert all([r.vec_id for r in found[q]] == want[q] for q in hot)


def test_rows_of_visits_do_not_grow_with_the_leaves(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LEAF", 32)
    counts, visit = [], neighbours.visit

    def counted(plan, placed, k):
        rows = neighbours.materialise(visit(plan, placed, k))
        counts.append(rows.count())
        return rows

    monkeypatch.setattr(neighbours, "visit", counted)
    data = np.random.default_rng(12).normal(size=(9000, 16)).astype(np.float32)
    found = answers(nearest_neighbours(table(spark, data), F.col("id") % 90 == 0, recall=1.0))
    want = brute(range(9000), data, range(0, 9000, 90), 20)
    hits = sum(len({r.vec_id for r in found[q]} & set(want[q])) for q in want)
    assert hits >= 0.99 * 20 * len(want)
    # 21 rows for each leaf of the square root of the visits would be over 400 a query.
    assert len(counts) == 3 and sum(counts) <= 250 * len(want)


def test_rounds_end_with_the_last_visit():
    for wide in (1, 2, 4, 5, 64, 65, 300, 70_000):
        ends = neighbours.round_ends(wide)
        assert ends == sorted(ends) and ends[-1] == wide and (wide <= 4 or ends[0] == 4)
        assert all(b <= 16 * a + 1 for a, b in zip(ends, ends[1:]))


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    data = [[1, 0], None, [0, 0], [nan, 1], [inf, 1], [None, 1], [], [1, 2, 3], [2, 0], [0, 1]]
    vectors = clashing(table(spark, data, 20), "id", "vector").unionAll(
        clashing(spark.createDataFrame([(None, [5.0, 5.0], None)], VECTORS), "id", "vector")
    )
    found = answers(nearest_neighbours(vectors, F.col("id") >= 20))
    assert {q: [r.vec_id for r in rows] for q, rows in found.items()} == {
        20: [28, 29], 28: [20, 29], 29: [20, 28],
    }


def test_rows_of_a_repeated_id_are_told_apart(spark):
    vectors = spark.createDataFrame(
        [(0, [1.0, 0.0], 0), (0, [0.5, 0.0], 0), (1, [0.0, 1.0], 0), (1, [0.0, 1.0], 0)], VECTORS
    )
    rows = nearest_neighbours(vectors, F.col("id") == 0).collect()
    found = sorted((r.rank, r.vec_id, r.score) for r in rows if r.query_id == 0)
    # Each of the two rows of id 0 finds the other one, then both rows of id 1.
    assert found == [(1, 0, 0.5)] * 2 + [(2, 1, 0.0)] * 2 + [(3, 1, 0.0)] * 2


def test_every_length_and_every_row_is_searched(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LEAF", 12)
    monkeypatch.setattr(neighbours, "CROWDED", 20)
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    rng = np.random.default_rng(7)
    rows = []
    for k in range(600):
        size = (3, 8, 5)[0 if k % 3 == 0 else 1 if k % 7 else 2]
        rows.append((k % 450, rng.normal(size=size).astype(np.float32)))
    rows.append((20, np.ones(11, np.float32)))  # alone of its length
    vectors = spark.createDataFrame([(i, v.tolist(), 0) for i, v in rows], VECTORS)
    got = nearest_neighbours(vectors, F.col("id") % 10 == 0, k=6, recall=1.0).collect()
    want = Counter()
    for at, (i, v) in enumerate(rows):
        if i % 10 == 0:
            near = sorted(
                (-float(np.dot(w.astype(float), v.astype(float))), j)
                for b, (j, w) in enumerate(rows) if b != at and len(w) == len(v)
            )[:6]
            want.update((i, r + 1, j, round(-s, 9)) for r, (s, j) in enumerate(near))
    found = Counter((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in got)
    assert sum(found.values()) == sum(want.values())
    assert sum((found & want).values()) >= 0.99 * sum(want.values())


@pytest.mark.parametrize("n", [0, 1])
def test_tiny_tables(spark, n):
    assert nearest_neighbours(table(spark, [[1.0, 2.0]][:n]), F.col("id") == 0).count() == 0


def test_best_bins_visit_every_leaf_once():
    data = np.random.default_rng(3).normal(size=(2000, 8))
    tree = Tree(data, np.random.default_rng(4))
    order = tree.best_bins(data[0], tree.leaves)
    assert sorted(order) == list(range(tree.leaves)) and tree.leaves > 8
    assert tree.best_bins(data[0], 3) == order[:3]
    assert set(tree.leaf_of(data).tolist()) <= set(order)
    assert Tree(np.ones((1000, 3)), np.random.default_rng(5)).leaves == 1


def test_split_leaves_hand_their_vectors_on():
    data = np.random.default_rng(8).normal(size=(900, 4))
    tree = Tree(data, np.random.default_rng(9))
    before = tree.leaf_of(data)
    crowded = int(np.bincount(before).argmax())
    inside = data[before == crowded]
    tree.split({crowded: inside[:3]})
    after = tree.leaf_of(data)
    assert (after[before != crowded] == before[before != crowded]).all()
    assert crowded not in after and len(set(after[before == crowded].tolist())) == 3
    assert sorted(tree.best_bins(data[0], tree.leaves)) == sorted(set(range(tree.leaves)) - {crowded})
    bare = Tree(np.empty((0, 0)), np.random.default_rng(10))
    bare.split({0: np.eye(4)})
    assert set(bare.leaf_of(data).tolist()) == {1, 2, 3, 4}


def test_crowded_leaves_are_split_until_none_is(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CROWDED", 30)
    data = np.random.default_rng(11).normal(size=(1200, 5)).astype(np.float32)
    data[:200] = 1  # equal vectors cannot be told apart
    rows = table(spark, data).select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), F.col("vec_id").alias("key")
    )
    forest = neighbours.fitted(rows, sample=100)
    sizes = {r["leaf"]: r["count"] for r in neighbours.grown(rows, forest).groupBy("leaf").count().collect()}
    assert sum(sizes.values()) == 1200 and len(sizes) > 30
    assert sorted(sizes.values())[-2] <= 30 and 200 <= max(sizes.values()) <= 230


def test_block_search_breaks_ties_by_id():
    rng = random.Random(6)
    ids = np.array(rng.sample(range(1000), 300))
    data = np.array([[rng.randrange(3), rng.randrange(3)] for _ in ids], np.float64)
    query, at, score = nearest_of(data[:50], data, ids, 9)
    for q in range(50):
        mine = query == q
        want = sorted((-float(d @ data[q]), int(i)) for d, i in zip(data, ids, strict=True))[:9]
        assert [(-s, int(i)) for s, i in zip(score[mine], ids[at[mine]], strict=True)] == want
