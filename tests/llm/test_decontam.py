import collections
import hashlib
import random

import pytest

from mortar.llm.decontam import decontaminate, find_matches, match_digest

from .conftest import words


def brute(rows, items, width=10):
    windows = collections.defaultdict(set)
    for i, t in items:
        w = words(t)
        for s in range(max(len(w) - width, 0) + 1 if w else 0):
            windows[tuple(w[s:s + width])].add(i)
    sizes = {len(k) for k in windows}
    out = []
    for d, t in rows:
        w, hit, found = words(t), set(), set()
        for s in range(len(w)):
            for n in sizes:
                k = tuple(w[s:s + n])
                if len(k) == n and k in windows:
                    hit.update(range(s, s + n))
                    found |= windows[k]
        named = ",".join(sorted(map(str, found)))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(named.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def got(docs, bench):
    return sorted([tuple(r)[:6] for r in match_digest(docs, bench).collect()], key=str)


@pytest.fixture(scope="module")
def bench_of(spark):
    return lambda items: spark.createDataFrame(items, "item_id long, text string")


def test_edges_against_brute_force(docs_of, bench_of):
    made = random.Random(3)
    vocabulary = ["the", "of", "a", "Éa", "naïve", "x1", *[f"w{i}" for i in range(40)]]
    passages = [" ".join(made.choice(vocabulary) for _ in range(n)) for n in (10, 14, 25, 3, 1, 12, 30)]
    items = [*enumerate(passages), (7, None), (8, ""), (9, "..."), (10, passages[0]), (2, passages[2]), (11, "the the")]
    texts = [None, "", "!!!", "the", "The THE the", passages[0], f"x {passages[1].upper()} y",
             " ".join(made.choice(vocabulary) for _ in range(400)),
             f"{passages[2]}, {passages[2]}; {passages[5]}", " ".join(passages[6].split()[1:]),
             "word " * 30_000 + passages[1], passages[0], passages[2].replace(" ", " \n--")]
    rows = [*enumerate(texts), (5, passages[0]), (5, "another text"), (None, passages[1])]
    docs = docs_of([t for _, t in rows], [i for i, _ in rows])
    assert got(docs, bench_of(items)) == brute(rows, items)
    assert got(docs, bench_of([])) == brute(rows, [])
    assert got(docs_of([]), bench_of(items)) == []


def test_whole_table_against_brute_force(spark, sf0001_docs):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    rows = [(r.doc_id, r.text) for r in sf0001_docs.collect()]
    items = [(r.item_id, r.text) for r in bench.collect()]
    assert got(sf0001_docs, bench) == brute(rows, items)


def test_proximity_and_filter(docs_of, bench_of):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    moved = "alpha beta gamma extra delta epsilon zeta eta theta iota kappa"
    docs = docs_of([item, moved, "nothing of the kind here"])
    found = {r.doc_id: r for r in find_matches(docs, bench_of([(1, item)])).collect()}
    assert len(found[0].exact) == 1 and not found[1].exact and len(found[1].near) >= 1 and found[2].near is None
    kept = decontaminate(docs.selectExpr("*", "7 AS wid", "8 AS exact", "9 AS term"), bench_of([(1, item)]))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2]
