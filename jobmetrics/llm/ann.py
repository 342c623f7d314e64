"""Nearest neighbours by inner product: a forest of random-projection trees, then exact ranking.

The trees are grown on the driver from a bounded sample (`SAMPLE_ROWS` vectors of the smallest
hashes) and broadcast. A query walks all trees with one priority queue: the branch with the best
worst margin comes next, until a share of all leaves is found. Vectors are dealt into shards, where
each finds its leaf in every tree, and a query meets only the vectors in its own leaves. Of these a
matrix product picks the pairs that can be among the best, and sums in a fixed order in double
precision rank them. The share, not a number, of leaves is fixed, so recall does not fall as the table
grows, and work a query does grows with the table.

An inner product becomes an angle by giving every vector one more component, so that all have the
length of the longest. Equal vectors are one entry with its smallest ids, of which more than k + 1
can never be in a result, so many copies of one vector are neither a large leaf nor many queries.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do those of
another than the most frequent length, nor rows without id. Of rows with the same id the smallest
vector counts. Ties go to the smaller id. Fewer vectors than k give fewer rows. Other columns are
ignored.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from jobmetrics.llm.common import map_batches
from jobmetrics.session import materialise

SAMPLE_ROWS = 20_000
TREES = 10
LEAF_ROWS = 1024  # at most wanted in a leaf, over all shards
LEAST_DEPTH = 6  # of a tree, so that a share of the leaves of a small table is many of them
LEAST_SAMPLE = 8  # sampled vectors a node must hold to be split
PROBE_SHARE = 0.12  # of the leaves of all trees, which a query visits
LEAST_SHARDS = 12  # so that small tables use several cores
SHARD_ROWS = 20_000  # vectors, and queries, that one call ranks
PAIRS = 4_000_000  # pairs whose inner products are in memory at once
SEED = 7


@dataclass(frozen=True)
class Tree:
    """Inner nodes; a child below zero is the leaf -1 - child. A tree of one leaf has no nodes."""

    directions: np.ndarray
    thresholds: np.ndarray
    children: np.ndarray
    leaves: int


def grow(sample: np.ndarray, depth: int, random: np.random.Generator) -> Tree:
    directions, thresholds, children, leaves = [], [], [], 0

    def split(rows: np.ndarray, level: int) -> int:
        nonlocal leaves
        if level < depth and len(rows) >= 2 * LEAST_SAMPLE:
            for _ in range(5):
                a, b = sample[random.choice(rows, 2, replace=False)]
                way = a - b
                length = np.sqrt(way @ way)
                if length == 0:
                    continue
                way = way / length
                along = sample[rows] @ way
                middle = float(np.median(along))
                left = along < middle
                if LEAST_SAMPLE <= left.sum() <= len(rows) - LEAST_SAMPLE:
                    me = len(directions)
                    directions.append(way)
                    thresholds.append(middle)
                    children.append([0, 0])
                    children[me] = [split(rows[left], level + 1), split(rows[~left], level + 1)]
                    return me
        leaves += 1
        return -leaves

    root = split(np.arange(len(sample)), 0)
    width = sample.shape[1]
    tree = Tree(
        np.array(directions).reshape(-1, width), np.array(thresholds), np.array(children, dtype=int).reshape(-1, 2), leaves
    )
    assert root == (0 if directions else -1)
    return tree


@dataclass(frozen=True)
class Forest:
    trees: list[Tree]
    longest: float

    def lengthened(self, x: np.ndarray) -> np.ndarray:
        """Vectors with the component that makes them as long as the longest."""
        rest = np.sqrt(np.maximum(0.0, self.longest**2 - (x * x).sum(1)))
        return np.hstack([x, rest[:, None]])

    def leaves_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every (lengthened) row in every tree."""
        out = np.zeros((len(x), len(self.trees)), dtype=np.int64)
        for t, tree in enumerate(self.trees):
            at = np.zeros(len(x), dtype=int) if len(tree.thresholds) else np.full(len(x), -1)
            while (inner := np.flatnonzero(at >= 0)).size:
                node = at[inner]
                right = (x[inner] * tree.directions[node]).sum(1) >= tree.thresholds[node]
                at[inner] = tree.children[node, right.astype(int)]
            out[:, t] = -1 - at
        return out

    def numbered(self) -> np.ndarray:
        """The number of the first leaf of each tree, and after the last one the number of leaves."""
        return np.concatenate([[0], np.cumsum([t.leaves for t in self.trees])]).astype(np.int64)

    def probe(self, query: np.ndarray, share: float) -> np.ndarray:
        """The numbers of the leaves to visit, best first, from one queue over all trees."""
        first = self.numbered()
        wanted = int(np.ceil(share * first[-1]))
        length = np.sqrt(query @ query)
        q = np.append(query * (self.longest / length), 0.0)
        margins = [(tree.directions @ q - tree.thresholds).tolist() for tree in self.trees]
        children = [tree.children.tolist() for tree in self.trees]
        queue = [(-np.inf, t, 0 if len(tree.thresholds) else -1) for t, tree in enumerate(self.trees)]
        heapq.heapify(queue)
        found: list[int] = []
        while queue and len(found) < wanted:
            worst, t, node = heapq.heappop(queue)
            while node >= 0:  # the better child is at least as good as what is left in the queue
                m = margins[t][node]
                left, right = children[t][node]
                near, far = (right, left) if m >= 0 else (left, right)
                heapq.heappush(queue, (max(worst, abs(m)), t, far))
                node = near
            found.append(int(first[t]) - 1 - node)
        return np.array(found, np.int32)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vid and v (array<double>) of the vectors that take part, one row per id."""
    v = F.col(vector_col)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & fine & F.exists(v, lambda x: x != 0)).select(
        F.col(id_col).cast("long").alias("vid"), v.cast("array<double>").alias("v")
    )
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (common["n"] if common else -1)).groupBy("vid").agg(F.min("v").alias("v"))


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))


def fit(distinct: DataFrame, rows: int, width: int, trees: int, leaf_rows: int, sample_rows: int) -> Forest:
    """Grow the forest from the vectors of the smallest hashes."""
    longest = distinct.agg(F.max(norm(F.col("v")))).first()[0]
    sampled = distinct.orderBy(F.xxhash64("vid"), "vid").limit(sample_rows).select("v").collect()
    sample = np.array([r["v"] for r in sampled], dtype=float).reshape(-1, width)
    forest = Forest([], longest)
    depth = max(LEAST_DEPTH, int(np.ceil(np.log2(max(1, rows / leaf_rows)))))
    grown = [grow(forest.lengthened(sample), depth, np.random.default_rng([SEED, t])) for t in range(trees)]
    return Forest(grown, longest)


def _matrix(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(rows, -1)


def inner_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of each pair of rows; sums over the components in their order, so that equal pairs have equal scores everywhere."""
    out = np.zeros(len(x))
    for d in range(x.shape[1]):
        out += x[:, d] * y[:, d]
    return out


def _best(pair: np.ndarray, rough: np.ndarray, n: int, slack: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the pairs (query * n + vector) those that can be among their query's k best, and its k-th score."""
    pair, first = np.unique(pair, return_index=True)  # a vector may be in a query's leaves of several trees
    at, rough = pair // n, rough[first]
    order = np.lexsort((-rough, at))
    pair, at, rough = pair[order], at[order], rough[order]
    size = np.bincount(at, minlength=len(slack))
    start = np.cumsum(size) - size
    least = np.full(len(slack), -np.inf)
    full = size >= k
    least[full] = rough[start[full] + k - 1]
    kept = rough >= (least - slack)[at]
    return pair[kept], rough[kept], least


def rank_in_leaves(
    x: np.ndarray, leaf: np.ndarray, q: np.ndarray, visits: list[np.ndarray], k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of q and x with their score: of each query the k best (and ties) among the vectors in its leaves.

    Leaves are visited in rounds, the best ones of every query first, each round four times the one
    before. What a round finds is kept only where it reaches the k-th best so far.
    """
    flat = leaf.ravel()
    by_leaf = np.argsort(flat, kind="stable")
    rows, keys = by_leaf // leaf.shape[1], flat[by_leaf]
    # Both ways of summing, by a matrix product and in order, are off by less than this.
    slack = 4 * q.shape[1] * np.finfo(float).eps * np.sqrt((q * q).sum(1)) * np.sqrt((x * x).sum(1).max())
    pair, rough, least = np.zeros(0, np.int64), np.zeros(0), np.full(len(q), -np.inf)
    start, stop = 0, 2
    while start < max(map(len, visits)):
        parts = [v[start:stop] for v in visits]
        asked, asking = np.concatenate(parts), np.repeat(np.arange(len(q)), [len(v) for v in parts])
        order = np.argsort(asked, kind="stable")
        asked, asking = asked[order], asking[order]
        pairs, scores = [pair], [rough]
        for key in np.unique(asked):
            xs = rows[slice(*np.searchsorted(keys, [key, key + 1]))]
            every = asking[slice(*np.searchsorted(asked, [key, key + 1]))]
            for qs in np.array_split(every, 1 + len(every) * len(xs) // PAIRS) if len(xs) else ():
                found = q[qs] @ x[xs].T
                floor = least[qs]
                if len(xs) > k:
                    floor = np.maximum(floor, np.partition(found, len(xs) - k, axis=1)[:, len(xs) - k])
                at, who = np.nonzero(found >= (floor - slack[qs])[:, None])
                pairs.append(qs[at] * len(x) + xs[who])
                scores.append(found[at, who])
        pair, rough, least = _best(np.concatenate(pairs), np.concatenate(scores), len(x), slack, k)
        start, stop = stop, 4 * stop
    at, who = pair // len(x), pair % len(x)
    scores = inner_products(q[at], x[who])
    pair, scores, _ = _best(pair, scores, len(x), np.zeros(len(q)), k)
    return pair // len(x), pair % len(x), scores


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
    trees: int = TREES, leaf_rows: int = LEAF_ROWS, probe_share: float = PROBE_SHARE, sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: of each query the k nearest rows of `vectors` but its own."""
    spark = vectors.sparkSession
    by_vector = Window.partitionBy("v").orderBy("vid")
    few = usable(vectors, id_col, vector_col).withColumn("_k", F.row_number().over(by_vector)).where(F.col("_k") <= k + 1)
    distinct = materialise(
        few.groupBy("v").agg(F.min("vid").alias("vid"), F.array_sort(F.collect_list("vid")).alias("ids")), "vectors"
    )
    asked = materialise(usable(queries, id_col, vector_col), "queries")
    asked_once = asked.groupBy("v").agg(F.min("vid").alias("vid")).select("vid", "v")
    size = distinct.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).first()
    rows, width = size["n"], size["d"] or 0
    if not rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    forest = spark.sparkContext.broadcast(fit(distinct, rows, width, trees, leaf_rows, sample_rows))

    def probe_step(batch: pa.RecordBatch) -> pa.RecordBatch:
        visits = [forest.value.probe(v, probe_share).tobytes() for v in _matrix(batch.column("v"), batch.num_rows)]
        return pa.RecordBatch.from_arrays([batch.column("vid"), batch.column("v"), pa.array(visits, pa.binary())], names=["vid", "v", "visits"])

    # Of other lengths than the vectors' nothing is near.
    probing = map_batches(asked_once.where(F.size("v") == width), lambda: probe_step, "vid long, v array<double>, visits binary")
    probing = materialise(probing, "asked")
    left = max(LEAST_SHARDS, -(-rows // SHARD_ROWS))
    right = max(1, -(-probing.count() // SHARD_ROWS))

    def shard(count: int) -> Column:
        return F.pmod(F.xxhash64("vid"), F.lit(count)).cast("int")

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    index = distinct.select("vid", "v", shard(left).alias("i")).withColumn("j", every(right))
    asking = probing.withColumn("j", shard(right)).withColumn("i", every(left))

    def rank(x_rows: pa.Table, q_rows: pa.Table) -> pa.Table:
        """The best k + 1 of each query among its leaves' vectors in a shard."""
        found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        if x_rows.num_rows and q_rows.num_rows:
            f = forest.value
            x, q = _matrix(x_rows.column("v"), x_rows.num_rows), _matrix(q_rows.column("v"), q_rows.num_rows)
            leaf = f.leaves_of(f.lengthened(x)) + f.numbered()[:-1]
            visits = [np.frombuffer(v, np.int32) for v in q_rows.column("visits").to_pylist()]
            at, who, scores = rank_in_leaves(x, leaf, q, visits, k + 1)
            found = (q_rows.column("vid").to_numpy()[at], x_rows.column("vid").to_numpy()[who], scores)
        return pa.table(dict(zip(("qid", "vid", "score"), found)))

    found = index.groupBy("i", "j").cogroup(asking.groupBy("i", "j")).applyInArrow(rank, "qid long, vid long, score double")
    by_query = Window.partitionBy("qid").orderBy(F.desc("score"), "vid")
    best = found.withColumn("_k", F.row_number().over(by_query)).where(F.col("_k") <= k + 1).drop("_k")
    hits = best.join(distinct.select("vid", "ids"), "vid").select("qid", "score", F.explode("ids").alias("vec_id"))
    # Every query row takes the list of its vector.
    firsts = probing.select("v", F.col("vid").alias("qid"))
    members = asked.join(firsts, "v").select(F.col("vid").alias("query_id"), "qid")
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        members.join(hits, "qid")
        .where(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(own))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
