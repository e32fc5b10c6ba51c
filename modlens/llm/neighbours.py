"""Approximate nearest neighbours by inner product: a forest of random-projection trees.

Vectors are scaled into the unit ball and lifted onto the sphere by one more component, so the largest inner
product is the least angle.  A tree splits by a random direction per level, at the median of the sample's
projections in each node.  A query walks all trees through one priority queue, leaf by leaf, nearest
first; what the leaves hold is reranked exactly.

The forest is fitted on a bounded sample; every vector is indexed.  Equal vectors are indexed once, with as many
of their smallest ids as a result can hold, and equal queries are searched once.  Leaves are cut into blocks of bounded
size, so a leaf with very many vectors or queries is many tasks.
"""

from __future__ import annotations

from heapq import heappop, heappush
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Distinct vectors that the forest is fitted on at most: those with the smallest digests.
SAMPLE = 32_768
TREES = 8
#: Vectors of the sample in a leaf at least.
LEAF = 256
#: Leaves a query visits, over all trees: the first of these by which so many of the sample's own neighbours are found.
VISITS = (80, 96, 112, 128, 160, 192, 256, 320, 384, 512, 768, 1024)
RECALL = 0.93
#: Vectors of the sample that are searched for among all of it to measure that.
PROBES = 200
BLOCK = 8192


class Forest(NamedTuple):
    """Per tree: a direction per level (trees, components, depth) and a threshold per inner node (trees, nodes)."""

    directions: np.ndarray
    cuts: np.ndarray
    depth: int
    scale: float

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        x = vectors / self.scale
        return np.hstack([x, np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1)))[:, None]])

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf number in each tree: (vectors, trees)."""
        x, out = self.lifted(vectors), np.zeros((len(vectors), len(self.cuts)), np.int64)
        for t in range(len(self.cuts)):
            at, node = x @ self.directions[t], np.zeros(len(x), np.int64)
            for level in range(self.depth):
                node = 2 * node + 1 + (at[:, level] > self.cuts[t][node])
            out[:, t] = (node - ((1 << self.depth) - 1)) + (t << self.depth)
        return out

    def visit(self, query: np.ndarray, visits: int) -> list[int]:
        """Leaves of all trees, nearest first by the squared margins crossed on the way."""
        size = float(np.sqrt(query @ query))
        at = np.concatenate([query / size, [0.0]]) @ self.directions  # (trees, depth)
        heap = [(0.0, t, 0, 0) for t in range(len(self.cuts))]
        found, first_leaf = [], (1 << self.depth) - 1
        while heap and len(found) < visits:
            far, t, node, level = heappop(heap)
            while level < self.depth:
                margin = float(at[t, level] - self.cuts[t, node])
                right = margin > 0
                heappush(heap, (far + margin * margin, t, 2 * node + 2 - right, level + 1))
                node, level = 2 * node + 1 + right, level + 1
            found.append(node - first_leaf + (t << self.depth))
        return found


def fit_forest(sample: np.ndarray, scale: float, trees: int = TREES, leaf: int = LEAF, seed: int = 11) -> Forest:
    """Balanced trees over the sample."""
    depth = max(0, int(np.floor(np.log2(max(1, len(sample)) / leaf))))
    rng = np.random.default_rng(seed)
    width = sample.shape[1] + 1
    directions = rng.normal(size=(trees, width, depth)) / np.sqrt(width)
    forest = Forest(directions, np.zeros((trees, max(1, (1 << depth) - 1))), depth, scale)
    x = forest.lifted(sample)
    for t in range(trees):
        at, node = x @ directions[t], np.zeros(len(x), np.int64)
        for level in range(depth):
            for n in range((1 << level) - 1, (2 << level) - 1):
                here = node == n
                forest.cuts[t, n] = np.median(at[here, level]) if here.any() else 0.0
            node = 2 * node + 1 + (at[:, level] > forest.cuts[t][node])
    return forest


def choose_visits(forest: Forest, sample: np.ndarray, k: int = 20, target: float = RECALL, probes: int = PROBES) -> int:
    """The least number of leaves by which ``target`` of the ``k`` nearest in the sample are found, over ``probes`` of its vectors.

    Leaves hold more of a larger table, and its nearest are nearer, so what is found there is not less.
    """
    n_leaves = len(forest.cuts) << forest.depth
    some = np.random.default_rng(5).permutation(len(sample))[:probes]
    held = forest.leaves(sample)
    tried = [v for v in VISITS if v < n_leaves]
    found = np.zeros(len(tried) + 1)
    for i in some.tolist():
        near = np.argsort(-(sample @ sample[i]), kind="stable")[: k + 1]
        near = near[near != i][:k]
        place = np.full(n_leaves, n_leaves)
        path = forest.visit(sample[i], tried[-1] if tried else 0)
        place[path] = np.arange(len(path))
        first = place[held[near]].min(axis=1)  # how many leaves come before the first that holds it
        found[:-1] += [np.mean(first < v) if len(near) else 1.0 for v in tried]
    for v, share in zip(tried, found / max(1, len(some)), strict=False):
        if share >= target:
            return v
    return n_leaves


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows, in double precision."""
    if not len(column):
        return np.zeros((0, 1))
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def nearest(df: DataFrame, k: int = 20, key: str = "vec_id", vector: str = "embedding", every: int = 20, sample: int = SAMPLE,
            trees: int = TREES, visits: int | None = None) -> DataFrame:
    """For every row whose key is divisible by ``every``: query_id, rank (from 1), vec_id, score of the ``k`` nearest other rows found.

    Nearness is the inner product in double precision, ties go to the smaller key; all other rows, if there are
    fewer than ``k``.  ``visits`` leaves are looked into for each, by default as many as :func:`choose_visits` finds enough.  Rows take no part with a null key, or a vector that is null, zero, holds null or non-finite components,
    or has another number of components than most.  Repeated rows count as one.  Nothing comes of an empty table.
    """
    spark = df.sparkSession
    kind = "array<float>" if df.schema[vector].dataType.simpleString() == "array<float>" else "array<double>"
    numbers = F.col(vector).cast("array<double>")
    fine = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(numbers, lambda x: x != 0)
    rows = df.select(F.col(key).cast("long").alias("id"), F.transform(numbers, lambda x: x + F.lit(0.0)).cast(kind).alias("v")).where(F.col("id").isNotNull() & F.coalesce(fine, F.lit(False))).distinct()
    sizes = rows.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)).alias("long"))
    most = sizes.orderBy(F.desc("n"), "size").first()
    result = "query_id bigint, rank int, vec_id bigint, score double"
    if most is None:
        return spark.createDataFrame([], result)
    dim, scale = most["size"], float(np.sqrt(most["long"])) * (1 + 1e-9)
    rows = rows.where(F.size("v") == dim)
    copies = Window.partitionBy("v").orderBy("id")
    index = rows.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1)
    chosen = index.where("copy = 1").orderBy(F.xxhash64("v"), "id").limit(sample).select("v").toArrow()
    fitted_on = _matrix(chosen["v"].combine_chunks())
    forest = fit_forest(fitted_on, scale, trees)
    visits = visits or choose_visits(forest, fitted_on, k)
    shared = spark.sparkContext.broadcast(forest)  # grows with the sample, not with the data

    def indexed(batches):
        for batch in batches:
            leaves = shared.value.leaves(_matrix(batch.column(1)))
            n, t = leaves.shape
            at = pa.array(np.repeat(np.arange(n), t))
            yield pa.RecordBatch.from_arrays([pa.array(leaves.ravel()), batch.column(0).take(at), batch.column(1).take(at)], ["leaf", "id", "v"])

    def asked(batches):
        for batch in batches:
            found = [shared.value.visit(q, visits) for q in _matrix(batch.column(1))]
            at = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            yield pa.RecordBatch.from_arrays([pa.array([x for f in found for x in f], pa.int64()), batch.column(0).take(at), batch.column(1).take(at)], ["leaf", "q", "v"])

    held = index.select("id", "v").mapInArrow(indexed, f"leaf bigint, id bigint, v {kind}")
    queries = rows.where(F.col("id") % every == 0)
    heads = queries.groupBy("v").agg(F.min("id").alias("q"))
    wanted = heads.select("q", "v").mapInArrow(asked, f"leaf bigint, q bigint, v {kind}")
    # tiles of bounded size: vectors and queries of a leaf are both dealt into blocks
    n_held = held.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("across"))
    n_asked = wanted.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("down"))
    shape = n_held.join(n_asked, "leaf")
    held = held.join(shape, "leaf").select("leaf", "id", "v", F.pmod(F.xxhash64("id"), F.col("across")).alias("x"), F.explode(F.sequence(F.lit(0), F.col("down") - 1).cast("array<bigint>")).alias("y"))
    wanted = wanted.join(shape, "leaf").select("leaf", "q", "v", F.pmod(F.xxhash64("q"), F.col("down")).alias("y"), F.explode(F.sequence(F.lit(0), F.col("across") - 1).cast("array<bigint>")).alias("x"))

    def ranked(left, right):
        ids, q = left["id"].to_numpy(), right["q"].to_numpy()
        if not len(ids) or not len(q):
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], ["q", "id", "score"])
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        vectors, asked_for = _matrix(left["v"].combine_chunks())[order], _matrix(right["v"].combine_chunks())
        out = []
        for at in range(0, len(q), 256):
            score = np.zeros((len(asked_for[at : at + 256]), len(ids)))
            for d in range(vectors.shape[1]):  # component by component: each sum is the same wherever it is made
                score += np.multiply.outer(asked_for[at : at + 256, d], vectors[:, d])
            for one, found in zip(q[at : at + 256], score, strict=True):
                if len(found) > k + 1:
                    least = np.partition(found, len(found) - k - 1)[len(found) - k - 1]
                    best = np.flatnonzero(found >= least)  # all that tie with the last, smaller ids first
                else:
                    best = np.arange(len(found))
                best = best[np.argsort(-found[best], kind="stable")][: k + 1]
                out.append((np.full(len(best), one), ids[best], found[best]))
        q, i, s = (np.concatenate(c) for c in zip(*out, strict=True))
        return pa.table([pa.array(q), pa.array(i), pa.array(s)], ["q", "id", "score"])

    tiles = held.groupBy("leaf", "x", "y").cogroup(wanted.groupBy("leaf", "x", "y")).applyInArrow(ranked, "q bigint, id bigint, score double")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    found = tiles.groupBy("q", "id").agg(F.max("score").alias("score")).withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    # each row asks with its vector's head; itself is left out
    members = queries.join(heads, "v").select("q", F.col("id").alias("query_id"))
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    out = members.join(found.select("q", "id", "score"), "q").where("id <> query_id").withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
    return out.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
