"""Exact top-k inner product search with KD-trees, one per shard.

Rows are cut into shards; every shard becomes a KD-tree of median splits
whose nodes keep the tight box of their points.  A query walks the tree best
first: the box bound is the largest inner product any point of the box could
have; a node whose bound is below the k-th score so far is left out with
all below it.  The k-th score is carried from shard to shard within a task;
every task starts from the k-th score among ``SEED`` rows of the table, which
no answer can fall below.

Queries go out in blocks of at most ``BLOCK`` (a bounded broadcast), each
block against all rows.

Sums of products are exact in floating point while they stay below 2^53; where
they may not, bounds get a slack above their rounding error and the scores of
what is left are computed in whole numbers of any size.

Defined cases: vectors that are null, empty, or hold a null or non-finite
component (or one that is no longer finite times the scale) take no part; a
score beyond the range of a long is given as the nearest long, its rank is
that of the true score; vectors of a length other than the query's are not
its candidates; a repeated vec_id is a candidate each time, never its own
query's, and queries with its smallest vector; equal scores go to the
smaller vec_id; fewer than k candidates give fewer rows.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from .text import cut

# Workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOP = 5
STEP = 50
SCALE = 256
BLOCK = 4096
LEAF = 256
SEED = 2048
SHARD = 16384
EXACT = float(2 ** 53)
LONG = 2 ** 63


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): floor(scale * x) of the vectors that take part."""
    x = F.col("embedding")

    def scaled(c):
        return c.cast("double") * F.lit(float(scale))

    def whole(y):  # from 2^53 on every double is a whole number (and may exceed a long)
        return F.when(F.abs(y) >= EXACT, y).otherwise(F.floor(y).cast("double"))
    fine = x.isNotNull() & (F.size(x) > 0) & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(scaled(c)) < float("inf")))
    made = F.transform(x, lambda c: whole(scaled(c)))
    return vectors.where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False))).select("vec_id", made.alias("v"))


class KdTree:
    """Median splits on the widest side; leaves of at most ``leaf`` points."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int = LEAF):
        self.nodes: list[tuple[int, int, int, int]] = []  # begin, end, left, right
        order = np.arange(len(ids))
        low, high = [], []
        todo = [(0, len(ids), -1, 0)]
        while todo:
            begin, end, parent, side = todo.pop()
            inside = points[order[begin:end]]
            low.append(inside.min(0))
            high.append(inside.max(0))
            at = len(self.nodes)
            self.nodes.append((begin, end, -1, -1))
            if parent >= 0:
                b, e, left, right = self.nodes[parent]
                self.nodes[parent] = (b, e, at, right) if side == 0 else (b, e, left, at)
            wide = high[-1] - low[-1]
            if end - begin > leaf and wide.max() > 0:
                middle = (end - begin) // 2
                part = np.argpartition(inside[:, int(wide.argmax())], middle)
                order[begin:end] = order[begin:end][part]
                todo += [(begin, begin + middle, at, 0), (begin + middle, end, at, 1)]
        self.ids, self.points = ids[order], points[order]
        self.low, self.high = np.array(low), np.array(high)
        self.far = np.maximum(np.abs(self.low[0]), np.abs(self.high[0]))

    def slack(self, query: np.ndarray) -> float:
        """Above the rounding error of any product with ``query``; 0 where there is none."""
        most = float(np.abs(query) @ self.far)
        return 0.0 if most < EXACT else most * len(query) * 2.0 ** -50

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Largest possible inner product of every query with every node's box."""
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        return up @ self.high.T + down @ self.low.T

    def search(self, query: np.ndarray, own: int, bound: np.ndarray, best: list, k: int, least: float) -> None:
        """Improve ``best``, a heap of the k best (score, -vec_id) so far; scores below ``least`` are out."""
        queue, slack = [(-bound[0], 0)], self.slack(query)
        while queue:
            most, at = heapq.heappop(queue)
            # an equal bound may still hold an equal score with a smaller id
            kth = max(least, best[0][0]) if len(best) >= k else least
            if -most + slack < kth:
                return
            begin, end, left, right = self.nodes[at]
            if left >= 0:
                heapq.heappush(queue, (-bound[left], left))
                heapq.heappush(queue, (-bound[right], right))
                continue
            scores = self.points[begin:end] @ query
            near = np.flatnonzero(scores >= kth - slack)
            ids = self.ids[begin:end]
            if len(near) > 4 * k:  # the leaf's own best come first
                near = near[np.lexsort((ids[near], -scores[near]))]
            for i in near:
                if ids[i] == own:
                    continue
                item = (true_product(self.points[begin + i], query) if slack else int(scores[i]), -int(ids[i]))
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)


def true_product(a: np.ndarray, b: np.ndarray) -> int:
    return sum(int(x) * int(y) for x, y in zip(a.tolist(), b.tolist()))


def sort_key(score: int) -> str:
    """Text that sorts as the whole number does, however large."""
    digits = str(abs(score))
    if score >= 0:
        return f"1{len(digits):03d}{digits}"
    return f"0{999 - len(digits):03d}" + "".join(str(9 - int(c)) for c in digits)


def _arrays(batch: pa.RecordBatch) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Points of a batch by dimension: {d: (ids, matrix)}."""
    ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
    lists = batch.column("v")
    sizes = np.diff(lists.offsets.to_numpy())
    flat, begin = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()[:-1]
    out = {}
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        out[int(d)] = (ids[rows], flat[begin[rows][:, None] + np.arange(d)])
    return out


def _least(seed: list, ids: np.ndarray, vectors: list, k: int) -> np.ndarray:
    """Each query's k-th score among the seed rows: a floor under its true k-th score."""
    out = np.full(len(ids), -np.inf)
    by_size: dict[int, list] = {}
    for r in seed:
        by_size.setdefault(len(r.v), []).append(r)
    for d, rows in by_size.items():
        asked = np.array([q for q, v in enumerate(vectors) if len(v) == d])
        if len(asked):
            asking, seeds = np.array([vectors[q] for q in asked]), np.array([r.v for r in rows])
            scores = asking @ seeds.T
            most = np.abs(asking) @ np.abs(seeds).max(0)
            scores -= np.where(most < EXACT, 0.0, most * d * 2.0 ** -50)[:, None]  # never above the true ones
            scores[ids[asked][:, None] == np.array([r.vec_id for r in rows])[None, :]] = -np.inf
            if len(rows) >= k:
                out[asked] = np.partition(scores, -k, axis=1)[:, -k]
    return out


def _blocks(queries: DataFrame, block: int) -> Iterator[tuple[np.ndarray, list]]:
    """Queries by rising vec_id, at most ``block`` at a time."""
    last = None
    while True:
        rest = queries if last is None else queries.where(F.col("vec_id") > last)
        rows = rest.orderBy("vec_id").limit(block).collect()
        if not rows:
            return
        yield np.array([r.vec_id for r in rows]), [np.array(r.v) for r in rows]
        last = rows[-1].vec_id


def search(rows: DataFrame, queries: DataFrame, k: int = TOP, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k best rows; both sides are (vec_id, v)."""
    spark = rows.sparkSession
    sc = spark.sparkContext
    queries = cut(queries.groupBy("vec_id").agg(F.min("v").alias("v")))
    seed = rows.limit(SEED).collect()
    found = None
    schema = "query_id long, vec_id long, score long, sort string"
    for ids, vectors in _blocks(queries, block):
        shared = sc.broadcast((ids, vectors, _least(seed, ids, vectors, k)))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own, vecs, least = shared.value
            sizes = np.array([len(v) for v in vecs])
            best: list[list] = [[] for _ in own]
            waiting: dict[int, list] = {}

            def visit(d: int) -> None:
                parts = waiting.pop(d)
                tree = KdTree(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
                asked = np.flatnonzero(sizes == d)
                for some in np.array_split(asked, max(1, len(asked) // 512)):
                    if len(some):
                        matrix = np.array([vecs[q] for q in some])
                        for q, query, bound in zip(some, matrix, tree.bounds(matrix)):
                            tree.search(query, own[q], bound, best[q], k, least[q])

            for batch in batches:
                for d, part in _arrays(batch).items():
                    waiting.setdefault(d, []).append(part)
                    if sum(len(p[0]) for p in waiting[d]) >= shard:
                        visit(d)
            for d in list(waiting):
                visit(d)
            flat = [(int(own[q]), -i, max(-LONG, min(LONG - 1, s)), sort_key(s)) for q, items in enumerate(best) for s, i in items]
            if flat:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*flat), kinds)],
                                                 names=["query_id", "vec_id", "score", "sort"])

        part = rows.mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], schema)
    # k rows a query and task are left: a small merge
    w = Window.partitionBy("query_id").orderBy(F.desc("sort"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def top_digest(vectors: DataFrame, k: int = TOP, step: int = STEP) -> DataFrame:
    """The contract's rows: queries are the vec_ids divisible by ``step``."""
    rows = integer_vectors(vectors.select("vec_id", "embedding"))
    return search(rows, rows.where(F.col("vec_id") % step == 0), k)
