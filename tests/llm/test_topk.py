import math
import random

import numpy as np

from mortar.llm.topk import KdTree, integer_vectors, search, sort_key, top_digest

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, step=50, k=5):
    fine = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in fine:
        if i % step == 0:
            queries[i] = min(v, queries.get(i, v))
    out = []
    for q, a in queries.items():
        scored = sorted((-sum(x * y for x, y in zip(a, v)), i) for i, v in fine if i != q and len(v) == len(a))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def got(spark, rows, **p):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    return sorted(tuple(r) for r in top_digest(df, **p).collect())


def test_edges_against_brute_force(spark):
    made = random.Random(4)
    rows = [(i, [made.choice([-1.0, -0.5, 0.0, 0.25, 0.5, 1.0]) for _ in range(4)]) for i in range(300)]  # many ties
    rows += [(301, None), (302, []), (350, [float("nan")] * 4), (303, [None, 1.0, 1.0, 1.0]), (304, [float("inf")] * 4),
             (400, [1.0, 2.0]), (401, [3.0, 1.0]), (100, [0.5] * 4), (7, [0.5] * 4), (None, [0.1] * 4), (450, [1.0] * 3)]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []
    assert got(spark, [(0, [1.0])]) == []


def test_blocks_and_shards_against_brute_force(spark):
    made = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(made.normal(0, 0.3, (1500, 8)).astype(np.float32))]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(3)
    ints = integer_vectors(df)
    out = search(ints, ints.where("vec_id % 50 = 0"), 5, block=7, shard=300)
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in out.collect()) == brute(rows)


def test_large_components_rank_by_the_true_score(spark):
    big = [(i, [1e12 + i, 1.0, -2.0 ** 60]) for i in range(0, 60, 5)] + [(i, [2.0 ** 40, float(i), 2.0 ** 60]) for i in range(61, 90)]
    big += [(100, [3e38, -3e38, 1.0]), (150, [-3e38, 3e38, 2.0]), (200, [float(2 ** 24 + 1)] * 3), (201, [float(2 ** 24 + 1)] * 3)]
    df = spark.createDataFrame([(i, v, 0) for i, v in big], "vec_id long, embedding array<double>, label int").repartition(3)
    want = []
    ints = {i: [math.floor(256 * x) for x in v] for i, v in big}
    for q in (i for i in ints if i % 50 == 0):
        scored = sorted((-sum(x * y for x, y in zip(ints[q], v)), i) for i, v in ints.items() if i != q)
        want += [(q, r + 1, i, max(-2 ** 63, min(2 ** 63 - 1, -s))) for r, (s, i) in enumerate(scored[:5])]
    assert sorted(tuple(r) for r in top_digest(df).collect()) == sorted(want)
    numbers = [0, -1, 1, 9, 10, -9, -10, 10 ** 40, -10 ** 40, 10 ** 40 + 1]
    assert sorted(numbers, key=sort_key) == sorted(numbers)


def test_boxes_are_tight_and_bounds_hold():
    made = np.random.default_rng(6)
    points = made.integers(-50, 50, (2000, 6)).astype(float)
    tree = KdTree(np.arange(2000), points, leaf=64)
    queries = made.integers(-50, 50, (20, 6)).astype(float)
    bound = tree.bounds(queries)
    for at, (begin, end, _, _) in enumerate(tree.nodes):
        inside = tree.points[begin:end]
        assert (inside.min(0) == tree.low[at]).all() and (inside.max(0) == tree.high[at]).all()
        assert (queries @ inside.T).max(1).max() <= bound[:, at].max()
        assert ((queries @ inside.T).max(1) <= bound[:, at]).all()
