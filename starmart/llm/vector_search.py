"""Nearest vectors by inner product through a hierarchical k-means tree, searched best bin first.

The largest inner product is the smallest distance once every vector gets one more component that brings it to the length of
the longest (and a query gets a zero there), so the tree is built and searched by distance. It is fitted on a bounded sample;
every vector is then put into a leaf. A query keeps a priority queue of nodes by the distance of their centres and takes leaves
from it, nearest first. How many it visits is calibrated: for some queries the true neighbours are found by comparing with
every vector, and the visits are widened until the leaves visited hold the wanted share of them.

Leaves are cut into shards of bounded size, so that a leaf that a third of all vectors share is many tasks, and shards are dealt
into buckets. A query is sent once to each bucket that holds leaves it visits, compared with these leaves in blocks, and
leaves the bucket with its best few. Scores are double-precision sums over the original components.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.operators.staged import stage

from .common import map_batches

# Vectors the tree is fitted on, lowest hash of the id first; children of a node; sample vectors of a leaf, about.
SAMPLE = 16_384
BRANCHES = 8
LEAF = 64
# Queries that calibrate the visits, and the share of their true neighbours that must lie in the visited leaves.
CALIBRATION_QUERIES = 256
TARGET = 0.95
# Vectors of one shard of a leaf; vectors of a bucket, which holds many shards; queries that a bucket compares at once.
SHARD = 4096
BUCKET = 8192
BLOCK = 128
# Spreads a leaf's shards and neighbouring leaves over the buckets.
_STEP = 31


@dataclass
class Tree:
    """Nodes by number; ``leaf`` is a leaf's number or -1."""

    longest: float
    centres: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    leaves: int = 0

    def lengthened(self, vectors: np.ndarray) -> np.ndarray:
        """One component more, so that all have the longest length; a sampled tree meets no longer ones."""
        rest = np.maximum(self.longest**2 - (vectors**2).sum(axis=1), 0)
        return np.column_stack([vectors, np.sqrt(rest)])

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf of each vector: the nearest child, from the root down."""
        points, at = self.lengthened(vectors), np.zeros(len(vectors), np.int64)
        active = np.arange(len(vectors))
        while len(active):
            for node in np.unique(at[active]):
                own = active[at[active] == node]
                if self.children[node]:
                    options = np.array(self.children[node])
                    centres = np.array([self.centres[c] for c in options])
                    distance = (centres**2).sum(axis=1) - 2 * points[own] @ centres.T
                    at[own] = options[distance.argmin(axis=1)]
            active = active[[bool(self.children[n]) for n in at[active]]]
        return np.array(self.leaf)[at]

    def best_first(self, query: np.ndarray) -> Iterator[int]:
        """Leaves by a priority queue of nodes, nearest centre first."""
        point = np.append(query, 0.0)
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                yield self.leaf[node]
            for child in self.children[node]:
                heapq.heappush(queue, (float(((self.centres[child] - point) ** 2).sum()), child))


def _k_means(points: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    """Cluster of each point, by Lloyd's rounds from different points of the set."""
    distinct = np.unique(points, axis=0)
    centres = distinct[rng.choice(len(distinct), min(k, len(distinct)), replace=False)]
    own = np.zeros(len(points), np.int64)
    for _ in range(rounds):
        own = ((centres**2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)
        centres = np.array([points[own == c].mean(axis=0) if (own == c).any() else centres[c] for c in range(len(centres))])
    return own


def fit_tree(sample: np.ndarray, longest: float, branches: int = BRANCHES, leaf: int = LEAF, seed: int = 7) -> Tree:
    tree, rng = Tree(longest), np.random.default_rng(seed)

    def grow(points: np.ndarray) -> int:
        node = len(tree.centres)
        tree.centres.append(points.mean(axis=0) if len(points) else np.zeros(points.shape[1]))
        tree.children.append([])
        tree.leaf.append(-1)
        own = _k_means(points, branches, rng) if len(points) > leaf else np.zeros(len(points), np.int64)
        parts = [points[own == c] for c in np.unique(own)]
        if len(parts) > 1:
            for part in parts:
                child = grow(part)
                tree.children[node].append(child)
        else:
            tree.leaf[node] = tree.leaves
            tree.leaves += 1
        return node

    grow(tree.lengthened(sample))
    return tree


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one width as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _nearest(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, rough: np.ndarray):
    """(query, id, score) of each query's ``k`` best, ties to smaller ids, each id once; -inf in ``rough`` leaves a vector out."""
    for i, query in enumerate(query_ids):
        scores = rough[i]
        near = every = np.flatnonzero((ids != query) & (scores > -np.inf))
        if len(near) > k:
            cut = np.partition(scores[near], len(near) - k)[len(near) - k]
            near = near[scores[near] >= cut - 1e-9 * max(1.0, abs(cut))]
        while True:
            # The same sum for every vector, wherever it lies in the matrix.
            exact = (vectors[near] * queries[i]).sum(axis=1)
            order = np.lexsort((ids[near], -exact))
            found, first = np.unique(ids[near][order], return_index=True)
            if len(found) >= k or len(near) == len(every):
                break
            near = every  # copies of one id took places
        for j in np.sort(first)[:k]:
            yield int(query), int(ids[near][order[j]]), float(exact[order[j]])


def _found(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[], [], []]
    types = (pa.int64(), pa.int64(), pa.float64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["query_id", "vec_id", "score"])


def _best(found: DataFrame, k: int) -> DataFrame:
    """Rank of each query's ``k`` best ids."""
    each = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def valid_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(``id``, ``vector`` as doubles): rows with an id and a vector that is finite, without nulls and not zero."""
    cast = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = cast.where(F.col("id").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("vector", lambda x: x != 0))
    widths = kept.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), "width").first()
    return kept.where(F.size("vector") == (widths[0] if widths else 0))


def search(
    vectors: DataFrame,
    k: int = 20,
    every: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    sample: int = SAMPLE,
    calibration_queries: int = CALIBRATION_QUERIES,
    target: float = TARGET,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` of the ``k`` nearest found for each id divisible by ``every``.

    Nearness is the inner product. Candidates are all vectors but the query's own id; ties go to the smaller id; all are
    returned where there are no more than ``k``. Vectors that are null, zero, or hold nulls or non-finite components take no
    part, nor do rows without an id or of another width than most. Rows of one id are one item, as near as the nearest of its vectors.
    An empty table gives an empty one. Extra columns are left behind.
    """
    spark = vectors.sparkSession
    valid = stage(valid_vectors(vectors, id_col, vector_col), "vectors")
    length = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x, F.sqrt)
    total, longest = valid.agg(F.count("*"), F.max(length)).first()
    if not total:
        empty = valid.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score"))
        return empty.limit(0)
    drawn = valid.orderBy(F.xxhash64("id"), "id", "vector").limit(sample).select("vector").collect()
    tree = fit_tree(np.array([row[0] for row in drawn], float), longest)
    sent = spark.sparkContext.broadcast(tree)

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                leaf = pa.array(sent.value.assign(_matrix(batch.column(1))))
                yield pa.RecordBatch.from_arrays([*batch.columns, leaf], names=["id", "vector", "leaf"])

    placed = stage(map_batches(valid, assign, "id long, vector array<double>, leaf long"), "leaves")
    # One number per leaf, and the sample bounds the leaves.
    sizes = dict(map(tuple, placed.groupBy("leaf").count().collect()))
    is_query = F.col("id") % every == 0
    visits = _calibrated(placed.where(is_query), placed, tree, k, calibration_queries, target)
    shards = {leaf: -(-n // SHARD) for leaf, n in sizes.items()}

    # By the vectors alone: a query leaves each bucket with its best few, so more buckets than they need are more rows.
    buckets = total // BUCKET + 1

    def probe(batches):
        """A row for each query and bucket with leaves that the query visits."""
        tree = sent.value
        for batch in batches:
            rows, where, visited = [], [], []
            for row, query in enumerate(_matrix(batch.column(1))):
                seen, wanted = 0, defaultdict(set)
                for place, leaf in enumerate(tree.best_first(query)):
                    # Wider for a query whose leaves hold too few.
                    if place >= visits and seen > 2 * k:
                        break
                    seen += sizes.get(leaf, 0)
                    for shard in range(shards.get(leaf, 0)):
                        wanted[(leaf * _STEP + shard) % buckets].add(leaf)
                rows += [row] * len(wanted)
                where += wanted.keys()
                visited += [sorted(leaves) for leaves in wanted.values()]
            arrays = [column.take(pa.array(rows, pa.int64())) for column in batch.columns[:2]]
            arrays += [pa.array(where, pa.int64()), pa.array(visited, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "vector", "bucket", "leaves"])

    asked = map_batches(placed.where(is_query), probe, "id long, vector array<double>, bucket long, leaves array<long>")
    counts = F.broadcast(spark.createDataFrame(list(shards.items()), "leaf long, n long"))  # one row per leaf
    shard = F.pmod(F.xxhash64("id", "vector"), F.col("n"))
    stored = placed.join(counts, "leaf").select(
        "id", "vector", F.pmod(F.col("leaf") * _STEP + shard, F.lit(buckets)).alias("bucket"), F.array("leaf").alias("leaves")
    )
    rows = stored.withColumn("asks", F.lit(False)).unionByName(asked.withColumn("asks", F.lit(True)))
    dealt = rows.repartition(buckets, "bucket").sortWithinPartitions("bucket", "asks")

    def compare(batches):
        at, held, whole = None, [], None
        for batch in batches:
            bucket, asks = batch.column(2).to_numpy(), batch.column(4).to_numpy(zero_copy_only=False)
            ids, matrix, leaves = batch.column(0).to_numpy(), _matrix(batch.column(1)), batch.column(3).to_pylist()
            borders = np.flatnonzero((np.diff(bucket) != 0) | (np.diff(asks.astype(int)) != 0)) + 1
            for s, e in zip([0, *borders], [*borders, len(ids)]):
                if e > s and bucket[s] != at:
                    at, held, whole = bucket[s], [], None
                if e > s and not asks[s]:
                    held.append((ids[s:e], matrix[s:e], np.array([own[0] for own in leaves[s:e]])))
                elif e > s and held:
                    whole = whole or tuple(np.concatenate(part) for part in zip(*held))
                    for i in range(s, e, BLOCK):
                        part = slice(i, min(i + BLOCK, e))
                        rough = _visited(whole, matrix[part], leaves[part])
                        yield _found(list(_nearest(whole[0], whole[1], ids[part], matrix[part], k, rough)))

    found = map_batches(dealt, compare, "query_id long, vec_id long, score double")
    return _best(found, k).select("query_id", "rank", "vec_id", "score")


def _visited(held: tuple, queries: np.ndarray, leaves: list[list[int]]) -> np.ndarray:
    """Products of queries and the vectors of the leaves they visit; -inf elsewhere."""
    _, vectors, own = held
    rough = np.full((len(queries), len(vectors)), -np.inf)
    askers = defaultdict(list)
    for i, visited in enumerate(leaves):
        for leaf in visited:
            askers[leaf].append(i)
    for leaf in np.unique(own).tolist():
        if leaf in askers:
            members = np.flatnonzero(own == leaf)
            rough[np.ix_(askers[leaf], members)] = queries[askers[leaf]] @ vectors[members].T
    return rough


def _calibrated(queries: DataFrame, placed: DataFrame, tree: Tree, k: int, count: int, target: float) -> int:
    """Visits that reach the target: the place, in a query's order of leaves, of the leaf of each true neighbour."""
    drawn = queries.orderBy(F.xxhash64("id", F.lit(1)), "id").limit(count).select("id", "vector").collect()
    if not drawn:
        return 1
    ids, matrix = np.array([r[0] for r in drawn], np.int64), np.array([r[1] for r in drawn], float)
    sent = placed.sparkSession.sparkContext.broadcast((ids, matrix))

    def compare(batches):
        for batch in batches:
            own, vectors, leaf = batch.column(0).to_numpy(), _matrix(batch.column(1)), batch.column(2).to_numpy()
            for i in range(0, len(own), SHARD):
                part = slice(i, i + SHARD)
                queries, points = sent.value
                rows = list(_nearest(own[part], vectors[part], queries, points, k, points @ vectors[part].T))
                where = dict(zip(own[part].tolist(), leaf[part].tolist(), strict=True))
                found = _found(rows)
                yield found.append_column("leaf", pa.array([where[r[1]] for r in rows], pa.int64()))

    found = map_batches(placed, compare, "query_id long, vec_id long, score double, leaf long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    true = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "leaf").collect()
    places = {i: {leaf: p for p, leaf in enumerate(tree.best_first(q))} for i, q in zip(ids.tolist(), matrix)}
    needed = np.sort([places[query][leaf] + 1 for query, leaf in true])
    if not len(needed):
        return 1
    visits = 1
    while (needed <= visits).mean() < target:
        visits += max(1, visits // 16)
    return visits
