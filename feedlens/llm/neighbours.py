"""Approximate nearest neighbours by cosine: a hierarchical k-means tree, searched best bin first.

1. A tree of spherical k-means (``BRANCHES`` children a node) is fitted on a sample of at most
   ``SAMPLE_ROWS`` rows, those with the smallest hashes of their ids. Its leaves have about
   ``LEAF_ROWS`` rows of the table each, as far as the sample allows (``SAMPLE_PER_LEAF`` sampled
   rows a leaf, so at most ``SAMPLE_ROWS / SAMPLE_PER_LEAF`` leaves). The tree is small and goes
   to every task.
2. Every row is indexed: a task takes it down the tree to its leaf.
3. A query goes through the tree with a priority queue: the best node seen so far is opened,
   its children are queued by their likeness to the query, and a leaf taken from the queue is
   the next one to visit.
4. Calibration: for up to ``CALIBRATION`` queries the true neighbours are found by brute force
   over all rows, in blocks, and the number of visited leaves is widened until a share
   ``TARGET`` of them lies in the visited leaves. Every query then visits so many leaves.
5. Rows and the queries that visit their leaf meet in blocks of at most about ``BLOCK_ROWS`` rows
   by ``BLOCK_QUERIES`` queries; each block gives the nearest few of each of its queries, and a
   window over these picks the nearest.

Equal vectors cannot be told apart by any tree: of equal vectors only the smallest ``k + 1`` ids
take part (a query can be one of them), chosen by a window whose group limit works before the
shuffle, so a vector that a third of all rows share is no hot group. Scores are computed on the
original vectors in double precision, by the same summation for every pair.

Defined cases: vectors that are null, zero or hold null or non-finite components take no part,
nor do rows without an id, nor vectors of another length than most have (the shortest of equally
frequent lengths); rows that repeat an id are one vector with the best of their scores; ties go
to the smaller id; an empty table gives no rows; further columns do not matter.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.llm.common import bounded_batches, land

#: Neighbours returned, and ids that are queries.
NEAREST, QUERY_EVERY = 5, 50
#: Children of a node, rows of the table meant for a leaf, rows the tree is fitted on, and those a leaf needs.
BRANCHES, LEAF_ROWS, SAMPLE_ROWS, SAMPLE_PER_LEAF = 8, 256, 32_768, 8
#: Rounds of k-means.
ROUNDS = 8
#: Queries whose true neighbours are found, and the share of them that the visited leaves must hold.
CALIBRATION, TARGET = 256, 0.96
#: Rows and queries that meet at a time.
BLOCK_ROWS, BLOCK_QUERIES = 2048, 1024

INDEX_SCHEMA = "vec_id bigint, vector array<double>, leaf int"


@dataclass
class Tree:
    """Nodes in breadth-first order: ``centres`` of unit length; children of node k are
    ``first[k] .. first[k] + count[k] - 1``; a node without children is a leaf with a number."""

    centres: np.ndarray
    first: np.ndarray
    count: np.ndarray
    leaf: np.ndarray

    @property
    def leaves(self) -> int:
        return int((self.count == 0).sum())

    def descend(self, units: np.ndarray) -> np.ndarray:
        """The leaf of each row: the likest child at every node."""
        at = np.zeros(len(units), np.int64)
        while True:
            inner = np.flatnonzero(self.count[at])
            if not len(inner):
                return self.leaf[at]
            for node in np.unique(at[inner]).tolist():
                rows = inner[at[inner] == node]
                children = self.centres[self.first[node] : self.first[node] + self.count[node]]
                at[rows] = self.first[node] + np.argmax(units[rows] @ children.T, axis=1)

    def visits(self, unit: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves for a query, best bin first."""
        queue, found = [(-1.0, 0)], []
        while queue and len(found) < most:
            _, node = heapq.heappop(queue)
            if not self.count[node]:
                found.append(int(self.leaf[node]))
                continue
            lo, hi = int(self.first[node]), int(self.first[node] + self.count[node])
            for child, likeness in zip(range(lo, hi), (self.centres[lo:hi] @ unit).tolist(), strict=True):
                heapq.heappush(queue, (-likeness, child))
        return found


def scaled_rows(vectors: np.ndarray) -> np.ndarray:
    """Each row times a power of two (which changes no cosine), so that squares neither overflow nor vanish."""
    if not len(vectors):
        return vectors
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows of unit length."""
    scaled = scaled_rows(vectors)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True)) if len(scaled) else scaled


def split_cluster(units: np.ndarray, k: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: centres and the number of each row's centre; empty clusters go."""
    centres = units[rng.choice(len(units), min(k, len(units)), replace=False)]
    for _ in range(ROUNDS):
        own = np.argmax(units @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, units)
        length = np.sqrt((sums * sums).sum(axis=1))
        centres = sums[length > 0] / length[length > 0, None]
    own = np.argmax(units @ centres.T, axis=1)
    used, own = np.unique(own, return_inverse=True)
    return centres[used], own


def fit_tree(units: np.ndarray, leaves: int, seed: int = 0) -> Tree:
    """A tree with about ``leaves`` leaves: the node with most rows is split next."""
    rng = np.random.default_rng(seed)
    dim = units.shape[1] if units.ndim == 2 else 0
    centres, children, members = [np.zeros(dim)], [[]], [np.arange(len(units))]
    queue, count = [(-len(units), 0)], 1
    while queue and count < leaves:
        size, node = heapq.heappop(queue)
        if -size < 2:
            break
        found, own = split_cluster(units[members[node]], BRANCHES, rng)
        if len(found) < 2:
            continue  # equal vectors
        for k, centre in enumerate(found):
            children[node].append(len(centres))
            rows = members[node][own == k]
            heapq.heappush(queue, (-len(rows), len(centres)))
            centres.append(centre)
            children.append([])
            members.append(rows)
        count += len(found) - 1
    order, at = [0], 0  # breadth first, so that children are neighbours
    first, number = [], []
    while at < len(order):
        node = order[at]
        first.append(len(order))
        number.append(len(children[node]))
        order += children[node]
        at += 1
    number = np.array(number)
    leaf = np.where(number == 0, np.cumsum(number == 0) - 1, -1)
    return Tree(np.array([centres[k] for k in order]), np.array(first), number, leaf)


def matrix(column) -> np.ndarray:
    """An Arrow list column of equal lengths as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.empty((0, 0))


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosine of each query with its row, summed alike for every pair."""
    queries, rows = scaled_rows(queries), scaled_rows(rows)
    return (queries * rows).sum(axis=1) / (np.sqrt((queries * queries).sum(axis=1)) * np.sqrt((rows * rows).sum(axis=1)))


def nearest_in_block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``query_id, vec_id, score`` of each query's k nearest rows of other ids; among those at
    the k-th score the smallest ids."""
    near = unit_rows(queries) @ unit_rows(rows).T
    near[query_ids[:, None] == ids[None, :]] = -np.inf
    if near.shape[1] > k:  # everything not clearly worse than the k-th
        bound = np.partition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k]
        near[near < bound[:, None] - 1e-9] = -np.inf
    q, r = np.nonzero(near > -np.inf)
    exact = scores(queries[q], rows[r]) if len(q) else np.empty(0)
    order = np.lexsort((ids[r], -exact, q))
    q, r, exact = q[order], r[order], exact[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    best = place < k
    return query_ids[q[best]], ids[r[best]], exact[best]


def usable_vectors(df: DataFrame, id_col: str, vector_col: str, k: int) -> DataFrame:
    """``vec_id, vector`` (doubles) of the rows that take part."""
    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = df.select(F.col(id_col).cast("bigint").alias("vec_id"), vector.alias("vector")).where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
    rows = rows.where(finite & F.exists("vector", lambda x: x != 0))
    lengths = rows.groupBy(F.size("vector").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").first()
    rows = rows.where(F.size("vector") == (lengths["dim"] if lengths else 0)).distinct()
    alike = Window.partitionBy(F.xxhash64("vector"), "vector").orderBy("vec_id")
    # a query keeps its own row; of the others equal to it the smallest ids are enough
    place = rows.withColumn("place", F.dense_rank().over(alike))
    return place.where(F.col("place") <= k + 1).select("vec_id", "vector")


def fitted_tree(vectors: DataFrame, n: int, sample_rows: int = SAMPLE_ROWS, leaf_rows: int = LEAF_ROWS) -> Tree:
    """The tree of the landed ``vectors`` (``n`` rows), from a bounded sample of them."""
    share = min(1.0, sample_rows / max(n, 1))
    hashed = F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(1 << 30))
    sample = vectors.where(hashed <= int(share * (1 << 30))).select("vec_id", "vector").limit(sample_rows).toArrow().sort_by("vec_id")
    units = unit_rows(matrix(sample.column("vector").combine_chunks()))
    return fit_tree(units, max(1, min(n // leaf_rows, len(units) // SAMPLE_PER_LEAF)))


def _indexer(tree):
    def index(batches):
        import pyarrow as pa

        fitted = Tree(*tree.value)
        for batch in batches:
            if batch.num_rows:
                leaf = fitted.descend(unit_rows(matrix(batch.column(1))))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(leaf, pa.int32())], names=["vec_id", "vector", "leaf"])

    return index


def _truth(asked, k: int):
    """Brute force of a few queries: each task gives its own nearest rows with their leaves."""

    def nearest(batches):
        import pyarrow as pa

        ids, queries = asked.value
        best: list[tuple] = []
        for batch in batches:
            for at in range(0, batch.num_rows, 4 * BLOCK_ROWS):
                part = batch.slice(at, 4 * BLOCK_ROWS)
                rows, leaf = part.column(0).to_numpy(), part.column(2).to_numpy()
                q, r, s = nearest_in_block(ids, queries, rows, matrix(part.column(1)), k)
                by = np.argsort(rows, kind="stable")
                best.append((q, r, s, leaf[by[np.searchsorted(rows, r, sorter=by)]]))
                if len(best) > 8:
                    best = [_merged(best, k)]
        if best:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _merged(best, k)], names=["query_id", "vec_id", "score", "leaf"])

    return nearest


def _merged(found: list[tuple], k: int) -> tuple:
    q, r, s, leaf = (np.concatenate([x[j] for x in found]) for j in range(4))
    order = np.lexsort((r, -s, q))
    q, r, s, leaf = q[order], r[order], s[order], leaf[order]
    best = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[best], r[best], s[best], leaf[best].astype(np.int32)


def calibrated_visits(indexed: DataFrame, queries: DataFrame, tree: Tree, k: int, target: float = TARGET, most: int = CALIBRATION) -> int:
    """The leaves a query has to visit: widened one by one until the visited ones hold a share
    ``target`` of the true neighbours of up to ``most`` queries."""
    chosen = queries.select("vec_id", "vector").orderBy(F.xxhash64("vec_id"), "vec_id").limit(most).toArrow()
    if not chosen.num_rows:
        return 1
    ids, vectors = chosen.column("vec_id").combine_chunks().to_numpy(), matrix(chosen.column("vector").combine_chunks())
    asked = indexed.sparkSession.sparkContext.broadcast((ids, vectors))
    rows = indexed.mapInArrow(_truth(asked, k), "query_id bigint, vec_id bigint, score double, leaf int")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    true = rows.withColumn("place", place).where(F.col("place") <= k).select("query_id", "leaf").collect()  # at most most * k rows
    wanted: dict[int, list[int]] = {}
    for r in true:
        wanted.setdefault(r["query_id"], []).append(r["leaf"])
    at = []  # for each true neighbour, the visit that finds it
    for i, unit in zip(ids.tolist(), unit_rows(vectors), strict=True):
        order = {leaf: v for v, leaf in enumerate(tree.visits(unit, tree.leaves), 1)}
        at += [order[leaf] for leaf in wanted.get(i, [])]
    at.sort()
    visits = 1
    while at and np.searchsorted(at, visits, "right") < target * len(at):
        visits += 1
    return visits


def _visitor(tree, visits: int):
    def visit(batches):
        import pyarrow as pa

        fitted = Tree(*tree.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [fitted.visits(u, visits) for u in unit_rows(matrix(part.column(1)))]
                leaf = np.array([x for f in found for x in f], np.int32)
                row = np.repeat(np.arange(len(found)), [len(f) for f in found])
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), pa.array(leaf)], names=["query_id", "leaf"])

    return visit


def _searcher(k: int):
    def search(key, rows, queries):
        import pyarrow as pa

        found = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        if rows.num_rows and queries.num_rows:
            ids, vectors = rows.column("vec_id").combine_chunks().to_numpy(), matrix(rows.column("vector").combine_chunks())
            asked, wanted = queries.column("query_id").combine_chunks().to_numpy(), matrix(queries.column("vector").combine_chunks())
            parts = [nearest_in_block(asked[at : at + BLOCK_QUERIES], wanted[at : at + BLOCK_QUERIES], ids, vectors, k) for at in range(0, len(asked), BLOCK_QUERIES)]
            found = tuple(np.concatenate([p[j] for p in parts]) for j in range(3))
        return pa.table([pa.array(x) for x in found], names=["query_id", "vec_id", "score"])

    return search


def nearest_neighbours(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = NEAREST, query_every: int = QUERY_EVERY, target: float = TARGET) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each row whose id is
    divisible by ``query_every``, among the rows of all other ids."""
    spark = df.sparkSession
    vectors = land(bounded_batches(usable_vectors(df, id_col, vector_col, k)), "vectors")
    n = vectors.count()
    tree = fitted_tree(vectors, n)
    shared = spark.sparkContext.broadcast((tree.centres, tree.first, tree.count, tree.leaf))  # arrays: workers need no package
    indexed = land(vectors.mapInArrow(_indexer(shared), INDEX_SCHEMA), "indexed")
    queries = query_vectors(df, id_col, vector_col, query_every, vectors)
    visits = calibrated_visits(indexed, queries, tree, k, target)
    visited = land(queries.mapInArrow(_visitor(shared, visits), "query_id bigint, leaf int"), "visits")

    sizes = indexed.groupBy("leaf").agg(F.count(F.lit(1)).alias("rows")).join(visited.groupBy("leaf").agg(F.count(F.lit(1)).alias("asked")), "leaf")
    blocks = F.broadcast(land(sizes.select("leaf", F.ceil(F.col("rows") / BLOCK_ROWS).cast("int").alias("row_blocks"), F.ceil(F.col("asked") / BLOCK_QUERIES).cast("int").alias("query_blocks")), "blocks"))  # a row for each leaf
    rows = indexed.join(blocks, "leaf").select(
        "leaf", F.pmod(F.xxhash64("vec_id"), "row_blocks").cast("int").alias("row_block"), F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)).alias("query_block"), "vec_id", "vector"
    )
    asked = visited.join(blocks, "leaf").select(
        "leaf", F.explode(F.sequence(F.lit(0), F.col("row_blocks") - 1)).alias("row_block"), F.pmod(F.xxhash64("query_id"), "query_blocks").cast("int").alias("query_block"), "query_id"
    )
    asked = asked.join(queries.select(F.col("vec_id").alias("query_id"), "vector"), "query_id")
    by = ["leaf", "row_block", "query_block"]
    found = rows.groupBy(*by).cogroup(asked.groupBy(*by)).applyInArrow(_searcher(k), "query_id bigint, vec_id bigint, score double")
    best = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query_vectors(df: DataFrame, id_col: str, vector_col: str, every: int, vectors: DataFrame) -> DataFrame:
    """The landed ``vec_id, vector`` of the queries: also those whose vector has enough smaller
    ids, so from the table, of the length that ``vectors`` have."""
    chosen = df.where(F.col(id_col).cast("bigint") % every == 0)
    some = vectors.limit(1).collect()
    dim = len(some[0]["vector"]) if some else 0
    vector = F.col(vector_col).cast("array<double>")
    rows = chosen.select(F.col(id_col).cast("bigint").alias("vec_id"), vector.alias("vector")).where(F.size("vector") == dim)
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return land(rows.where(finite & F.exists("vector", lambda x: x != 0)).distinct(), "queries")
