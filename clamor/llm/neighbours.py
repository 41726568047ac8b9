"""Approximate nearest neighbours in a hierarchical k-means tree.

Vectors meet those of their own length only, and each length has a tree.  The trees
are fitted on a bounded sample of vectors (those with the smallest hash), and every
vector is put in its leaf.  Leaves that come to hold too many vectors are split again,
each by a task of its own over a bounded sample of the leaf, until none does: the trees
grow with the table.  A query walks its tree best bin first: a priority queue holds the
branches that are not entered yet, by the inner product of the query with their centre,
and the leaves come out in the order in which they are worth a visit.  How many leaves
are visited is calibrated for each length: for a bounded sample of queries the true
neighbours are found by brute force over all vectors, and the visits are widened until
the target share of them lies in visited leaves.  A length of which the sample holds no
query has all its leaves visited.

Visits meet the leaves in blocks of bounded size on both sides, so that neither a
crowded leaf nor one that all queries visit is one task.  Of equal vectors only the
smallest ids can be among the nearest and only they are candidates; equal queries are
searched once.

Nearness is the largest inner product in double precision, ties go to the smaller id.
Vectors that are null, zero or hold null or non-finite components take no part, nor do
those without an id.  Rows that share an id are told apart: each is a candidate of its
own and, where the id is asked for, a query of its own, which does not find itself but
may find the others.  A vector alone of its length has no neighbours.  An empty table
gives no rows.  Other columns are not read, whatever their names.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clamor.llm.common import materialise

NEAREST = 20
SAMPLE = 20_000  # vectors the tree is fitted on
BRANCHES = 8
LEAF = 256  # sample vectors in a leaf at most, but for equal ones
CROWDED = 8192  # vectors of the table in a leaf at most, but for equal ones
LEAVES = 1 << 16  # in whose number the leaves of a larger table grow instead
LEAF_SAMPLE = 2048  # vectors that a crowded leaf is split by
ROUNDS = 8  # of each k-means
CALIBRATION = 200  # queries
RECALL = 0.95  # of the calibration queries
BLOCK = 4096  # vectors of a leaf searched at a time
QUERY_BLOCK = 2048
FIRST = 4  # leaves of the first round of visits
WIDER = 16  # times the leaves so far that a round goes on to at most
SEED = 20_771


def usable(vector: Column) -> Column:
    real = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return vector.isNotNull() & F.coalesce(real, F.lit(False)) & F.exists(
        vector, lambda x: F.coalesce(x, F.lit(0)) != 0
    )


def clean_vectors(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """key, id and vector of each row that takes part; the key tells rows apart."""
    return vectors.select(
        F.col(vec_id).alias("id"), F.col(vector).alias("vector"),
        F.monotonically_increasing_id().alias("key"),
    ).filter(F.col("id").isNotNull() & usable(F.col("vector")))


def k_means(data: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """The cluster of each row; Lloyd's rounds from random rows."""
    centres = data[rng.choice(len(data), k, replace=False)]
    for _ in range(ROUNDS):
        gap = (centres**2).sum(axis=1) / 2 - data @ centres.T
        near = gap.argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, data)
        counts = np.bincount(near, minlength=k)
        full = counts > 0
        centres[full] = sums[full] / counts[full, None]
    return near


class Tree:
    """Nodes with the centres of their children; leaves are numbered as they come."""

    def __init__(self, sample: np.ndarray, rng: np.random.Generator):
        self.centres: list[np.ndarray] = []
        self.children: list[list[int]] = []  # a leaf is -1 - its number
        self.swapped: dict[int, int] = {}
        self.leaves = 0  # numbers given; those of leaves that were split hold nothing
        self.root = self._grow(sample.astype(np.float64), rng) if len(sample) else self._leaf()

    def _leaf(self) -> int:
        self.leaves += 1
        return -self.leaves

    def _grow(self, data: np.ndarray, rng: np.random.Generator) -> int:
        if len(data) <= LEAF or (data == data[0]).all():
            return self._leaf()
        near = k_means(data, min(BRANCHES, len(data)), rng)
        parts = [data[near == c] for c in np.unique(near)]
        if len(parts) == 1:
            return self._leaf()
        node = len(self.children)
        self.centres.append(np.stack([p.mean(axis=0) for p in parts]))
        self.children.append([])
        self.children[node] = [self._grow(p, rng) for p in parts]
        return node

    def split(self, centres: dict[int, np.ndarray]) -> None:
        """Leaves by number become nodes with these centres and a new leaf for each."""
        for leaf, middle in centres.items():
            node = len(self.children)
            self.centres.append(middle)
            self.children.append([self._leaf() for _ in middle])
            self.swapped[-1 - leaf] = node
        self.root = self.swapped.get(self.root, self.root)
        self.children = [[self.swapped.get(c, c) for c in row] for row in self.children]
        self.swapped = {}

    def leaf_of(self, data: np.ndarray) -> np.ndarray:
        """The leaf whose centres are nearest on the way down, for each row."""
        found = np.full(len(data), self.root)
        while (found >= 0).any():
            for node in np.unique(found[found >= 0]):
                rows = np.flatnonzero(found == node)
                centres = self.centres[node]
                # Row by row alike for equal vectors, whatever stands beside them.
                gap = (centres**2).sum(axis=1) / 2 - np.einsum("ij,kj->ik", data[rows], centres)
                found[rows] = np.array(self.children[node])[gap.argmin(axis=1)]
        return -1 - found

    def best_bins(self, query: np.ndarray, visits: int) -> list[int]:
        """The first leaves in best-bin-first order."""
        queue, found, turn = [(0.0, 0, self.root)], [], 0
        while queue and len(found) < visits:
            node = heapq.heappop(queue)[2]
            if node < 0:
                found.append(-1 - node)
                continue
            for worth, child in zip(
                (self.centres[node] @ query).tolist(), self.children[node], strict=True
            ):
                turn += 1
                heapq.heappush(queue, (-worth, turn, child))
        return found


def matrix(column: pa.Array) -> np.ndarray:
    if not len(column):
        return np.empty((0, 0))
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each length, the rows that have it, and their vectors."""
    sizes = pc.list_value_length(column).to_numpy()
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield int(size), rows, matrix(column.take(pa.array(rows)))


class Forest:
    """A tree for each length.  A leaf's number holds its length and its place there."""

    def __init__(self, sample: pa.Array):
        rng = np.random.default_rng(SEED)
        self.trees = {size: Tree(data, rng) for size, _, data in by_length(sample)}
        self.bare = Tree(np.empty((0, 0)), rng)  # of a length that the sample lacks

    def of(self, size: int) -> Tree:
        return self.trees.get(size, self.bare)

    def leaf_of(self, column: pa.Array) -> np.ndarray:
        found = np.empty(len(column), np.int64)
        for size, rows, data in by_length(column):
            found[rows] = (size << 32) + self.of(size).leaf_of(data)
        return found

    def split(self, centres: dict[int, np.ndarray]) -> None:
        by_tree: dict[int, dict[int, np.ndarray]] = {}
        for leaf, middle in centres.items():
            by_tree.setdefault(leaf >> 32, {})[leaf & 0xFFFFFFFF] = middle
        for size, parts in by_tree.items():
            if size not in self.trees:
                self.trees[size] = Tree(np.empty((0, 0)), np.random.default_rng(SEED))
            self.trees[size].split(parts)


def nearest_of(
    queries: np.ndarray, data: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, place in data and score of the k best rows of data for each query; ties by
    id.  Rows below the query's floor are left out.

    Scores are summed in one order for all rows; the product of matrices, which may
    round otherwise, only picks those that come into question.
    """
    found = []
    for begin in range(0, len(queries), 256):
        rough = queries[begin : begin + 256] @ data.T
        edge = np.full((len(rough), 1), -np.inf)
        if len(data) > k:
            edge = np.partition(rough, len(data) - k, axis=1)[:, len(data) - k, None]
        if floor is not None:
            edge = np.maximum(edge, floor[begin : begin + 256, None])
        edge = np.where(np.isfinite(edge), edge - 1e-9 * (1 + np.abs(edge)), edge)
        query, at = np.nonzero(rough >= edge)
        score = np.einsum("ij,ij->i", data[at], queries[begin + query])
        order = np.lexsort((ids[at], -score, query))
        query, at, score = query[order], at[order], score[order]
        first = np.searchsorted(query, query)
        best = np.arange(len(query)) - first < k
        if floor is not None:
            best &= score >= floor[begin + query]
        found.append((begin + query[best], at[best], score[best]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def fitted(candidates: DataFrame, sample: int = SAMPLE) -> Forest:
    """candidates: id and vector.  At most ``sample`` vectors come to the driver."""
    rows = candidates.orderBy(F.xxhash64("vector"), "id").limit(sample).select("vector").toArrow()
    return Forest(rows.column("vector").combine_chunks())


def with_leaves(candidates: DataFrame, forest: Forest) -> DataFrame:
    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.record_batch(
                    [*batch.columns, pa.array(forest.leaf_of(batch.column("vector")))],
                    names=[*batch.schema.names, "leaf"],
                )

    kinds = ", ".join(f"{n} {t}" for n, t in candidates.dtypes)
    return candidates.mapInArrow(placed, f"{kinds}, leaf long")


def centres_of(leaf: pa.Table) -> pa.Table:
    """leaf and centre of each part of a sample of one leaf; one part if all are equal."""
    data = matrix(leaf.column("vector").combine_chunks())
    parts = [data]
    if not (data == data[0]).all():
        near = k_means(data, min(BRANCHES, len(data)), np.random.default_rng(SEED))
        parts = [data[near == c] for c in np.unique(near)]
    number = leaf.column("leaf")[0].as_py()
    return pa.table(
        {
            "leaf": pa.array([number] * len(parts), pa.int64()),
            "centre": pa.array([p.mean(axis=0).tolist() for p in parts], pa.list_(pa.float64())),
        }
    )


def grown(candidates: DataFrame, forest: Forest) -> DataFrame:
    """candidates with their leaves, of which crowded ones are split until none is.

    The driver holds the centres: a leaf has CROWDED vectors or, of a large table, 8 of
    LEAVES parts of it, whichever is more.
    """
    enough = max(CROWDED, BRANCHES * candidates.count() // LEAVES)
    order = Window.partitionBy("leaf").orderBy(F.xxhash64("vector"), "id")
    whole: set[int] = set()  # leaves of equal vectors
    while True:
        placed = materialise(with_leaves(candidates, forest))
        sizes = placed.groupBy("leaf").count().filter(F.col("count") > enough).collect()
        leaves = [(r["leaf"],) for r in sizes if r["leaf"] not in whole]
        if not leaves:
            return placed
        crowded = candidates.sparkSession.createDataFrame(leaves, "leaf long")
        parts: dict[int, list] = {}
        for r in (
            placed.join(F.broadcast(crowded), "leaf")
            .withColumn("place", F.row_number().over(order))
            .filter(F.col("place") <= LEAF_SAMPLE)
            .select("leaf", "vector")
            .groupBy("leaf").applyInArrow(centres_of, "leaf long, centre array<double>")
            .collect()
        ):
            parts.setdefault(r["leaf"], []).append(r["centre"])
        whole.update(leaf for leaf, middle in parts.items() if len(middle) == 1)
        forest.split({f: np.array(m) for f, m in parts.items() if len(m) > 1})


def calibrate(
    queries: DataFrame, placed: DataFrame, forest: Forest, k: int, recall: float
) -> dict[int, int]:
    """How many leaves to visit so that the share of true neighbours in them, over a
    bounded sample of queries and all vectors, reaches the recall; by length."""
    sample = queries.orderBy(F.xxhash64("vector"), "class").limit(CALIBRATION).toArrow()
    if not sample.num_rows:
        return {}
    own = sample.column("class").to_numpy()
    column = sample.column("vector").combine_chunks()
    asked = {size: (rows, data) for size, rows, data in by_length(column)}

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best of a partition: no more rows than queries times k + 1 are held."""
        kinds = (np.int64, np.int64, np.int64, np.int64, np.float64)
        held = [np.empty(0, t) for t in kinds]
        for batch in batches:
            ids, keys = batch.column("id").to_numpy(), batch.column("key").to_numpy()
            leaf = batch.column("leaf").to_numpy()
            for size, rows, data in by_length(batch.column("vector")):
                if size not in asked:
                    continue
                among, wanted = asked[size]
                q, at, score = nearest_of(wanted, data, ids[rows], k + 1)
                at = rows[at]
                new = (among[q], ids[at], keys[at], leaf[at], score)
                held = [np.concatenate(c) for c in zip(held, new, strict=True)]
            order = np.lexsort((held[1], -held[4], held[0]))
            held = [c[order] for c in held]
            first = np.searchsorted(held[0], held[0])
            held = [c[np.arange(len(first)) - first < k + 1] for c in held]
        other = held[2] != own[held[0]]
        yield pa.record_batch(
            [pa.array(c[other]) for c in held], names=["q", "id", "key", "leaf", "score"]
        )

    order = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    true = (
        placed.mapInArrow(best, "q long, id long, key long, leaf long, score double")
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= k)
        .groupBy("q", "leaf").count().collect()  # CALIBRATION * k rows at most
    )
    visits = {}
    for size, (rows, data) in asked.items():
        tree = forest.of(size)
        turns = {
            int(q): {leaf: i for i, leaf in enumerate(tree.best_bins(v, tree.leaves))}
            for q, v in zip(rows, data, strict=True)
        }
        found = np.zeros(tree.leaves)
        for r in true:
            if r["q"] in turns:
                found[turns[r["q"]][r["leaf"] & 0xFFFFFFFF]] += r["count"]
        wide, reached = 0, 0.0
        while reached < recall * found.sum():
            reached += found[wide]
            wide += 1
        visits[size] = max(1, wide)
    return visits


def round_ends(wide: int) -> list[int]:
    """Visits after which each round of visits ends: every round is wider than all before
    it together by the same factor, of WIDER at most."""
    steps = max(0, math.ceil(math.log(wide / FIRST, WIDER)))
    ends = [math.ceil(FIRST * (wide / FIRST) ** (n / steps)) for n in range(steps)]
    return [*ends, wide]


def visit_plan(queries: DataFrame, forest: Forest, visits: dict[int, int]) -> DataFrame:
    """class, vector and each leaf that the query visits, with the round it does so in."""

    def planned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, rows, data in by_length(batch.column("vector")):
                tree = forest.of(size)
                wide = visits.get(size, tree.leaves)
                bins = [[(size << 32) + b for b in tree.best_bins(q, wide)] for q in data]
                rounds = np.searchsorted(round_ends(wide), np.arange(wide), side="right")
                at = pa.array(rows)
                yield pa.record_batch(
                    [
                        batch.column("class").take(at), batch.column("vector").take(at),
                        pa.array(bins, pa.list_(pa.int64())),
                        pa.array([rounds[: len(b)] for b in bins], pa.list_(pa.int32())),
                    ],
                    names=["class", "vector", "leaves", "rounds"],
                )

    kind = queries.schema["vector"].dataType.simpleString()
    # The queries are a small file, the walk is not small: a part for each shuffle partition.
    parts = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    planned_rows = queries.repartition(parts, "class").mapInArrow(
        planned, f"class long, vector {kind}, leaves array<long>, rounds array<int>"
    )
    return planned_rows.select(
        "class", "vector", F.inline(F.arrays_zip(F.col("leaves").alias("leaf"), F.col("rounds").alias("round")))
    )


def search(
    queries: DataFrame, placed: DataFrame, forest: Forest, visits: dict[int, int], k: int
) -> DataFrame:
    """class, id, key, score: the k best of the visited leaves.

    The leaves of a query are searched in rounds.  Each adds only what is no worse than the
    k-th best of those before it, so a query gets about k rows for every WIDER-fold of its
    visits and not k for each of them.
    """
    plan = materialise(visit_plan(queries, forest, visits))
    order = Window.partitionBy("class").orderBy(F.desc("score"), "id")
    none = F.lit(float("-inf"))
    rounds = max(
        [len(round_ends(visits.get(s, t.leaves))) for s, t in forest.trees.items()], default=1
    )
    found = None
    for number in range(rounds):
        now = plan.filter(F.col("round") == number).drop("round")
        if found is None:
            rows = visit(now.withColumn("floor", none), placed, k)
        else:
            floors = found.filter(F.col("place") == k).select("class", F.col("score").alias("found"))
            now = now.join(floors, "class", "left").withColumn("floor", F.coalesce("found", none))
            rows = found.drop("place").unionAll(visit(materialise(now.drop("found")), placed, k))
        found = rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)
        if number < rounds - 1:
            found = materialise(found)
    return found.drop("place")


def visit(plan: DataFrame, placed: DataFrame, k: int) -> DataFrame:
    """class, id, key, score: the k best of every block of every leaf of the plan, without
    those below the floor of the class."""

    def blocks(rows: DataFrame, name: str, size: int) -> DataFrame:
        # A row for each leaf; CROWDED and LEAVES bound how many there are, but for lengths.
        count = F.ceil(F.count("*") / size).cast("int")
        return rows.groupBy("leaf").agg(count.alias(name))

    sizes = blocks(placed, "n_blocks", BLOCK).join(blocks(plan, "n_slices", QUERY_BLOCK), "leaf")
    sizes = F.broadcast(materialise(sizes))
    every = F.sequence(F.lit(0), F.col("n_slices") - 1)
    left = placed.join(sizes, "leaf").select(
        "leaf", F.pmod(F.xxhash64("key"), "n_blocks").cast("int").alias("block"),
        F.explode(every).alias("slice"), "id", "key", "vector",
    )
    every = F.sequence(F.lit(0), F.col("n_blocks") - 1)
    right = plan.join(sizes, "leaf").select(
        "leaf", F.explode(every).alias("block"),
        F.pmod(F.xxhash64("class"), "n_slices").cast("int").alias("slice"), "class", "vector",
        "floor",
    )

    def met(data: pa.Table, asked: pa.Table) -> pa.Table:
        names = ("class", "id", "key", "score")
        if not data.num_rows or not asked.num_rows:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
            return pa.table({n: pa.array([], t) for n, t in zip(names, kinds, strict=True)})
        ids, keys = data.column("id").to_numpy(), data.column("key").to_numpy()
        q, at, score = nearest_of(
            matrix(asked.column("vector").combine_chunks()),
            matrix(data.column("vector").combine_chunks()), ids, k,
            asked.column("floor").to_numpy(),
        )
        found = (asked.column("class").to_numpy()[q], ids[at], keys[at], score)
        return pa.table({n: pa.array(c) for n, c in zip(names, found, strict=True)})

    key = ["leaf", "block", "slice"]
    return (
        left.groupBy(*key).cogroup(right.groupBy(*key))
        .applyInArrow(met, "class long, id long, key long, score double")
    )


def nearest_neighbours(
    vectors: DataFrame, is_query: Column, k: int = NEAREST, recall: float = RECALL,
    vec_id: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each query, a row for whose
    id ``is_query`` (over the column ``id``) holds."""
    rows = materialise(clean_vectors(vectors, vec_id, vector))
    same = Window.partitionBy("vector").orderBy("id", "key")
    candidates = materialise(
        rows.withColumn("place", F.row_number().over(same)).filter(F.col("place") <= k + 1).drop("place")
    )
    forest = fitted(candidates)
    placed = grown(candidates, forest)
    asked = rows.filter(is_query)
    queries = materialise(asked.groupBy("vector").agg(F.min("key").alias("class")))
    members = asked.join(queries, "vector").select(
        "class", F.col("id").alias("query_id"), F.col("key").alias("query_key")
    )
    visits = calibrate(queries, placed, forest, k, recall)
    found = search(queries, placed, forest, visits, k + 1)
    by_query = Window.partitionBy("query_key").orderBy(F.desc("score"), "id")
    return (
        members.join(found, "class")
        .filter(F.col("key") != F.col("query_key"))
        .withColumn("rank", F.row_number().over(by_query))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias("vec_id"), "score")
    )
