"""Ranked lexical search: exact inner products over sparse ball trees.

A document is a sparse vector of saturated term frequencies over the terms
that the queries hold, a query one of term weights; the score is their
integer inner product.  Documents are read in shards; every shard becomes a
ball tree: nodes are split at the median along the line between two far
points, and hold the centroid of their points and the radii around it, of the
whole vector and of every term alone.  No point x of a node can score above
q.c + |q| r, nor above q.c + sum of q_t r_t; the lower of the two counts (for
sparse vectors of many terms it is the second: few of a ball's terms are the
query's).  A query visits the nodes best bound first and leaves out those
whose bound is below its k-th score so far, which it carries from shard to
shard.  At the leaves scores are computed in 64-bit integers.

Bounds are floating point, so they are rounded up: the squared radius and the
bound each get a margin far above the error of their sums.  A bound equal to
the k-th score is not left out, so ties are decided by doc_id alone.

Coordinates are scaled: a document's by the root of the term's weight, a
query's likewise.  Inner products stay as they are, and terms that weigh
little add little to the radii.

Queries go out in blocks of bounded size, each against all rows; documents,
statistics and trees stay on the executors.

Defined cases: a null or empty text has no terms; an item without terms, or
without a document above 0, has no rows; a repeated item_id asks once, with
its smallest text; a null item_id is an item; repeated documents are
documents each; a document with a null doc_id counts in all statistics but
cannot be named and is not ranked; empty tables give empty results; extra
columns are not read.
"""

from __future__ import annotations

import heapq
import math
import re
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from ..session import scratch_path
from .text import cut

# Workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# --- fixed values: the contract's scoring ------------------------------------
TOP = 20
SCALE = 1_000_000_000
TERM = rb"[0-9a-z\x80-\xff]+"  # of UTF-8 bytes with A-Z lower-cased
# --- end of fixed values ------------------------------------------------------

BLOCK_BYTES = 500_000  # texts of the queries that go out at a time
SHARD = 4096  # documents of a tree
SHARD_TERMS = 2_000_000  # terms of a tree's documents
LEAF = 32
PIECE = 4_000_000  # bytes of a text that are split into words at a time
MERGE = 256  # groups of a query's candidates before the last merge
NARROW = 64  # queries bounded at a time


def term_counts(text: bytes) -> Counter:
    """Occurrences of every term of a UTF-8 text, taken piece by piece."""
    text = text.lower()  # of bytes: A-Z only
    if len(text) <= PIECE:
        return Counter(re.findall(TERM, text))
    counts, begin = Counter(), 0
    gap = re.compile(rb"[^0-9a-z\x80-\xff]")
    while begin < len(text):
        at = gap.search(text, min(begin + PIECE, len(text)))
        end = at.start() if at else len(text)
        counts.update(re.findall(TERM, text[begin:end]))
        begin = end
    return counts


# --- the tree ------------------------------------------------------------------


class BallTree:
    """Ball tree of sparse rows (``begin`` offsets, ``term`` ids, ``value`` integers)."""

    def __init__(self, begin: np.ndarray, term: np.ndarray, value: np.ndarray, scale: np.ndarray, leaf: int = LEAF):
        self.begin, self.term, self.value = begin, term, value
        self.used, self.local = np.unique(term, return_inverse=True)
        self.x = value * scale[term]
        count = np.diff(begin)
        self.row = np.repeat(np.arange(len(count)), count)
        self.square = np.bincount(self.row, self.x * self.x, minlength=len(count))
        self.nodes: list[tuple[int, int]] = []  # left and right node, or -1 and the leaf's number
        self.leaves: list[np.ndarray] = []
        centre, radius, reach = [], [], []
        todo = [(np.arange(len(count)), -1, 0)]
        while todo:
            rows, parent, side = todo.pop()
            at = len(self.nodes)
            if parent >= 0:
                self.nodes[parent] = (at, self.nodes[parent][1]) if side == 0 else (self.nodes[parent][0], at)
            c = self._centre(rows)
            distance = self._distance(rows, c)
            centre.append(c)
            radius.append(math.sqrt(distance.max()))
            reach.append(self._reach(rows, c))
            if len(rows) > leaf and distance.max() > 0:
                self.nodes.append((-1, -1))
                one, two = self._halves(rows, distance)
                todo += [(one, at, 0), (two, at, 1)]
            else:
                self.nodes.append((-1, len(self.leaves)))
                self.leaves.append(rows)
        self.centre, self.radius, self.reach = np.array(centre), np.array(radius), np.array(reach)

    def _entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the rows' entries, and each entry's place in ``rows``."""
        count = self.begin[rows + 1] - self.begin[rows]
        owner = np.repeat(np.arange(len(rows)), count)
        first = np.cumsum(count) - count
        return self.begin[rows][owner] + np.arange(len(owner)) - first[owner], owner

    def _centre(self, rows: np.ndarray) -> np.ndarray:
        at, _ = self._entries(rows)
        return np.bincount(self.local[at], self.x[at], minlength=len(self.used)) / len(rows)

    def _reach(self, rows: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Each term's radius above the centroid (queries weigh no term below 0)."""
        at, _ = self._entries(rows)
        most = np.zeros(len(self.used))
        np.maximum.at(most, self.local[at], self.x[at])
        return np.maximum(most - c, 0)

    def _dot(self, rows: np.ndarray, dense: np.ndarray) -> np.ndarray:
        at, owner = self._entries(rows)
        return np.bincount(owner, self.x[at] * dense[self.local[at]], minlength=len(rows))

    def _distance(self, rows: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Squared distances from ``c``, rounded up."""
        own = c @ c
        exact = self.square[rows] - 2 * self._dot(rows, c) + own
        return np.maximum(exact, 0) + 1e-9 * (self.square[rows] + own)

    def _point(self, row: int) -> np.ndarray:
        dense = np.zeros(len(self.used))
        here = slice(self.begin[row], self.begin[row + 1])
        dense[self.local[here]] = self.x[here]
        return dense

    def _halves(self, rows: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        far = self._point(rows[int(distance.argmax())])
        other = self._point(rows[int(self._distance(rows, far).argmax())])
        order = np.argsort(self._dot(rows, far - other), kind="stable")
        return rows[order[: len(rows) // 2]], rows[order[len(rows) // 2:]]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """No point of a node scores above its bound; ``queries`` are dense over ``used``, scaled."""
        length = np.sqrt((queries * queries).sum(1))
        inner = queries @ self.centre.T
        spread = np.minimum(length[:, None] * self.radius[None, :], queries @ self.reach.T)
        return (inner + spread) * (1 + 1e-9) + 1

    def scores(self, leaf: int, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, integer scores) of a leaf; ``weight`` is dense over ``used``."""
        rows = self.leaves[leaf]
        at, owner = self._entries(rows)
        products = self.value[at] * weight[self.local[at]]
        total = np.zeros(len(rows), np.int64)
        np.add.at(total, owner, products)
        return rows, total


class Ranking:
    """The best (score, doc_id) of one query so far."""

    def __init__(self, k: int):
        self.k, self.heap = k, []

    def least(self) -> int:
        return self.heap[0][0] if len(self.heap) >= self.k else 1

    def add(self, score: int, doc_id: int) -> None:
        item = (score, -doc_id)
        if len(self.heap) < self.k:
            heapq.heappush(self.heap, item)
        elif item > self.heap[0]:
            heapq.heapreplace(self.heap, item)


def visit(tree: BallTree, ids: np.ndarray, bound: np.ndarray, weight: np.ndarray, best: Ranking) -> int:
    """Best-first search of one query in one tree; returns the documents scored."""
    queue, seen = [(-bound[0], 0)], 0
    while queue:
        most, at = heapq.heappop(queue)
        if -most < best.least():
            break
        left, right = tree.nodes[at]
        if left >= 0:
            heapq.heappush(queue, (-bound[left], left))
            heapq.heappush(queue, (-bound[right], right))
            continue
        rows, scores = tree.scores(right, weight)
        seen += len(rows)
        near = np.flatnonzero(scores >= best.least())
        if len(near) > 2 * best.k:  # the leaf's best first: the others then fall at once
            near = near[np.lexsort((ids[rows[near]], -scores[near]))][: best.k]
        for i in near:
            best.add(int(scores[i]), int(ids[rows[i]]))
    return seen


# --- the stages ------------------------------------------------------------------


def item_blocks(items: DataFrame, limit: int = BLOCK_BYTES) -> Iterator[list]:
    """Items (item_id, text), each id once, about ``limit`` bytes of text at a time."""
    asked = cut(items.groupBy("item_id").agg(F.min("text").alias("text")).where(F.length("text") > 0))
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-int(total) // limit)
    for b in range(n):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).collect()
        if rows:
            yield rows


def _counted(docs: DataFrame, vocabulary: dict) -> DataFrame:
    """(doc_id, n, terms, counts): all terms' number, and those of the vocabulary with their places."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            n, sizes, terms, counts = [], [0], [], []
            for text in batch.column("text"):
                found = term_counts(text.as_py()) if text.is_valid else {}
                n.append(sum(found.values()))
                for word, times in found.items():
                    place = known.get(word)
                    if place is not None:
                        terms.append(place)
                        counts.append(times)
                sizes.append(len(terms))
            offsets = pa.array(sizes, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64()))],
                names=["doc_id", "n", "terms", "counts"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode("text", "UTF-8").alias("text")).mapInArrow(
        run, "doc_id long, n long, terms array<int>, counts array<long>")


def _weights(counted: DataFrame, n_docs: int, terms: int) -> np.ndarray:
    """Weight of every vocabulary term; one count a term comes to the driver."""
    df = np.zeros(terms, np.int64)
    for place, seen in counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[place] = seen
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def _search(counted: DataFrame, queries: list[dict[int, int]], weights: np.ndarray, n_docs: int, n_words: int,
            k: int, shard: int, leaf: int) -> DataFrame:
    """(query, doc_id, score): each task's best of every query (its number in the list)."""
    shared = counted.sparkSession.sparkContext.broadcast((queries, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weight = shared.value
        scale = np.sqrt(weight.astype(np.float64))
        rankings = [Ranking(k) for _ in asked]
        waiting: list[tuple[np.ndarray, ...]] = []

        def search() -> None:
            ids = np.concatenate([w[0] for w in waiting])
            sizes, term, value = (np.concatenate([w[i] for w in waiting]) for i in (1, 2, 3))
            waiting.clear()
            tree = BallTree(np.concatenate([[0], np.cumsum(sizes)]), term, value, scale, leaf)
            place = np.full(len(weight), -1)
            place[tree.used] = np.arange(len(tree.used))
            for begin in range(0, len(asked), NARROW):
                dense = np.zeros((min(NARROW, len(asked) - begin), len(tree.used)), np.int64)
                for row, query in zip(dense, asked[begin:]):
                    for t, times in query.items():
                        if place[t] >= 0:
                            row[place[t]] = times
                bounds = tree.bounds(dense * scale[tree.used])
                exact = dense * weight[tree.used]
                for i in range(len(dense)):
                    if exact[i].any():
                        visit(tree, ids, bounds[i], exact[i], rankings[begin + i])

        for batch in batches:
            ids, sizes, term, value = _vectors(batch, weight, n_docs, n_words)
            first = 0
            while first < len(ids):  # shards end at so many documents, or terms
                room, free = shard - sum(len(w[0]) for w in waiting), SHARD_TERMS - sum(len(w[2]) for w in waiting)
                last = min(len(ids), first + room, first + max(1, int(np.searchsorted(np.cumsum(sizes[first:]), free))))
                low, high = int(sizes[:first].sum()), int(sizes[:last].sum())
                waiting.append((ids[first:last], sizes[first:last], term[low:high], value[low:high]))
                first = last
                if sum(len(w[0]) for w in waiting) >= shard or sum(len(w[2]) for w in waiting) >= SHARD_TERMS:
                    search()
        if waiting:
            search()
        found = [(q, -i, s) for q, r in enumerate(rankings) for s, i in r.heap]
        if found:
            q, ids, scores = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(q, pa.int32()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())],
                names=["query", "doc_id", "score"])

    rows = counted.where((F.size("terms") > 0) & F.col("doc_id").isNotNull())
    return rows.mapInArrow(run, "query int, doc_id long, score long")


def _vectors(batch: pa.RecordBatch, weight: np.ndarray, n_docs: int, n_words: int) -> tuple[np.ndarray, ...]:
    """(ids, entries a row, terms, values) of a batch; terms without weight add nothing and are left out."""
    ids = batch.column("doc_id").to_numpy()
    lists = batch.column("terms")
    sizes = np.diff(lists.offsets.to_numpy())
    low, high = lists.offsets[0].as_py(), lists.offsets[len(lists)].as_py()
    term = lists.values.to_numpy()[low:high]
    times = batch.column("counts").values.to_numpy()[low:high]
    m = np.array([75 + 25 * n * n_docs // n_words for n in batch.column("n").to_pylist()], np.int64)
    row = np.repeat(np.arange(len(ids)), sizes)
    value = (SCALE * times) // (1000 * times + 12 * m[row])
    keep = (weight[term] > 0) & (value > 0)
    return ids, np.bincount(row[keep], minlength=len(ids)), term[keep], value[keep]


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of every query, merged in two steps so that no task gets all candidates of one."""
    part = Window.partitionBy("query", "_part").orderBy(F.desc("score"), "doc_id")
    some = found.withColumn("_part", F.pmod(F.xxhash64("doc_id"), F.lit(MERGE))).withColumn(
        "rank", F.row_number().over(part)).where(F.col("rank") <= k).drop("rank", "_part")
    whole = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id")
    return some.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = TOP, shard: int = SHARD, leaf: int = LEAF,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): every item's ``k`` best documents of ``docs``."""
    spark = docs.sparkSession
    out, blocks = scratch_path(spark, "ranked"), 0
    kind = items.schema["item_id"].dataType.simpleString()
    schema = f"item_id {kind}, rank int, doc_id long, score long"
    for rows in item_blocks(items.select("item_id", "text"), block_bytes):
        counts = [term_counts(r.text.encode()) for r in rows]
        vocabulary = {w: i for i, w in enumerate(sorted(set().union(*counts)))}
        counted = cut(_counted(docs, vocabulary))
        n_docs, n_words = counted.where(F.col("n") > 0).agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs or not vocabulary:
            continue
        weights = _weights(counted, n_docs, len(vocabulary))
        queries = [{vocabulary[w]: c for w, c in found.items()} for found in counts]
        best = _best(_search(counted, queries, weights, n_docs, n_words, k, shard, leaf), k)
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], f"query int, item_id {kind}")
        best.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score").write.parquet(
            f"{out}/block={blocks}")
        blocks += 1
    if not blocks:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(out).select("item_id", "rank", "doc_id", "score")


def rank_digest(docs: DataFrame, items: DataFrame, **params) -> DataFrame:
    """The contract's rows: item_id, rank, doc_id, score."""
    return rank_documents(docs.select("doc_id", "text"), items, **params)
