import math
import random
from collections import Counter, defaultdict

import numpy as np

from mortar.llm.lexical import BallTree, Ranking, rank_digest, rank_documents, term_counts, visit

from .conftest import words

SF0001 = "/root/testdata/sf0.001"


def brute(rows, items, k=20):
    docs = [(i, Counter(words(t))) for i, t in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n_docs, n_words = len(docs), sum(n for _, _, n in docs)
    df = Counter(w for _, c, _ in docs for w in c)
    asked = {}
    for i, t in items:
        if t:
            asked[i] = min(t, asked.get(i, t))
    out = []
    for item, text in asked.items():
        scored = []
        for i, c, n in docs:
            m = 75 + 25 * n * n_docs // n_words
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                        * (10 ** 9 * c[w] // (1000 * c[w] + 12 * m)) for w, q in Counter(words(text)).items() if w in c)
            if score > 0 and i is not None:
                scored.append((-score, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def got(spark, rows, items, **p):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, rank int, score string")
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, query int")
    return sorted([tuple(r) for r in rank_documents(docs, asked, **p).collect()], key=str)


def corpus(n, seed):
    made = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "Straße", "x9"]
    return [(i, " ".join(made.choices(vocabulary, [1 / (j + 1) for j in range(63)], k=made.randint(0, 40))))
            for i in range(n)]


def test_edges_against_brute_force(spark):
    rows = corpus(200, 1) + [(300, None), (301, ""), (302, "-- !!"), (None, "w1 w2 É"), (7, "w3 w3"), (7, "w3 w3")]
    rows += [(400 + i, "copy of w5 w9") for i in range(50)] + [(500, "W5 " * 20000), (501, "w1,W2;x9_É")]
    items = [(1, "w1 w5 É"), (2, "W3 w3 w3 straße STRASSE"), (3, None), (4, "--"), (5, "unknown"), (None, "x9 w60"),
             (6, "w9 copy of"), (1, "w1 w5"), (6, "w9 copy of"), (8, "w0 " * 500)]
    assert got(spark, rows, items) == brute(rows, items)
    assert got(spark, rows, items, shard=16, leaf=4, block_bytes=20) == brute(rows, items)  # many trees and blocks
    assert got(spark, [], items) == [] and got(spark, rows, []) == []
    assert got(spark, [(1, None)], items) == []


def test_long_texts_piece_by_piece(monkeypatch):
    from mortar.llm import lexical
    text = " ".join(random.Random(2).choices(["ab", "Abc", "é", "x" * 50], k=3000)).encode()
    whole = term_counts(text)
    monkeypatch.setattr(lexical, "PIECE", 64)
    assert term_counts(text) == whole


def sparse(rows, terms, seed):
    made = np.random.default_rng(seed)
    lists = [np.sort(made.choice(terms, made.integers(1, 12), replace=False)) for _ in range(rows)]
    begin = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    term = np.concatenate(lists)
    return begin, term, made.integers(1, 10 ** 6, len(term))


def test_bounds_hold_and_prune():
    begin, term, value = sparse(1500, 40, 3)
    weight = np.random.default_rng(4).integers(0, 9000, 40)
    tree = BallTree(begin, term, value, np.sqrt(weight), leaf=16)
    made, scored = np.random.default_rng(5), 0
    for _ in range(30):
        query = made.integers(0, 3, len(tree.used)) * (made.random(len(tree.used)) < 0.2)
        exact = np.zeros(1500, np.int64)
        np.add.at(exact, tree.row, tree.value * (query * weight[tree.used])[tree.local])
        bound = tree.bounds((query * np.sqrt(weight[tree.used]))[None, :])[0]
        inside = defaultdict(list)
        for at in range(len(tree.nodes) - 1, -1, -1):  # children come after their parents
            left, right = tree.nodes[at]
            inside[at] = list(tree.leaves[right]) if left < 0 else inside[left] + inside[right]
            assert exact[inside[at]].max() <= bound[at]
        best = Ranking(10)
        if query.any():
            scored += visit(tree, np.arange(1500), bound, query * weight[tree.used], best)
            top = sorted((-s, i) for i, s in enumerate(exact) if s > 0)[:10]
            assert sorted((-s, -i) for s, i in best.heap) == top
    assert scored < 30 * 1500 * 0.9


def test_whole_small_table(spark, sf0001_docs):
    items = spark.read.parquet(f"{SF0001}/benchmark.parquet")
    rows = [(r.doc_id, r.text) for r in sf0001_docs.collect()]
    asked = [(r.item_id, r.text) for r in items.collect()]
    assert sorted([tuple(r) for r in rank_digest(sf0001_docs, items).collect()], key=str) == brute(rows, asked)
