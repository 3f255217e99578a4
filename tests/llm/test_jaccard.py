import collections
import random
import re

import numpy as np
import pytest

import mortar.llm.jaccard as jaccard
from mortar.llm.components import components
from mortar.llm.jaccard import Shingler, component_digest, keep_one

from .conftest import lower

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(lower(text))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            same = len(x & y)
            if same and 100 * same >= 80 * (len(x) + len(y) - same):
                parent[find(a)] = find(b)
    least = collections.defaultdict(list)
    for a, (i, _) in enumerate(sets):
        least[find(a)].append(i)
    return sorted([(i, len(s), min((x for x in least[find(a)] if x is not None), default=None))
                   for a, (i, s) in enumerate(sets)], key=str)


def got(df):
    return sorted([tuple(r) for r in component_digest(df).collect()], key=str)


def near_copies(seed=9, families=6):
    made = random.Random(seed)
    texts = [None, "", "  \n ", "one", "One", "a b c d", "A b\tc d", "a b c d e", "a b c d e f", "é É x y z q", "é é x y z q"]
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(made.choice(vocabulary) for _ in range(40))
    for _ in range(families):
        base = [made.choice(vocabulary) for _ in range(made.choice([8, 30, 66, 72, 78, 84, 120, 600]))]
        for _ in range(made.choice([3, 12, 40])):
            copy = list(base)
            for _ in range(made.randint(0, max(1, len(copy) // 60))):
                copy[made.randrange(len(copy))] = made.choice(vocabulary)
            texts.append(" ".join(copy))
        texts.append(" ".join(base) + " " + passage)
        texts += [" ".join(made.choice(vocabulary) for _ in range(30)) + " " + passage for _ in range(6)]
    return texts


def test_against_brute_force(docs_of):
    texts = near_copies()
    rows = [*enumerate(texts), (5, "a b c d"), (12, texts[12]), (3, "an entirely other text of document three here"),
            (None, texts[20])]
    assert got(docs_of([t for _, t in rows], [i for i, _ in rows])) == brute(rows)


@pytest.mark.parametrize("short", [2, 4])
def test_long_lists_and_frequent_tokens(docs_of, monkeypatch, short):
    monkeypatch.setattr(jaccard, "SHORT", short)
    monkeypatch.setattr(jaccard, "FREQUENT", 3)
    monkeypatch.setattr(jaccard, "LIST", 10)
    texts = near_copies(seed=short, families=8)
    assert got(docs_of(texts)) == brute(list(enumerate(texts)))


@pytest.mark.parametrize("rounds", [0, 2])
def test_sub_lists_of_a_key_meet(docs_of, monkeypatch, rounds):
    monkeypatch.setattr(jaccard, "LIST", 1)
    monkeypatch.setattr(jaccard, "PAIRS", 0)
    monkeypatch.setattr(jaccard, "ROUNDS", rounds)
    texts = []
    for f in range(8):  # a hot group of exact copies and one near copy of each length
        base = [f"f{f}w{i}" for i in range(16 + 12 * f)]
        texts += [" ".join(base)] * 30 + [" ".join(base) + " more"]
    base = [f"g{i}" for i in range(60)]  # and a chain of near copies
    texts += [" ".join(base[:i] + ["x"] + base[i + 1:]) for i in range(0, 60, 2)]
    assert got(docs_of(texts)) == brute(list(enumerate(texts)))


def test_empty_table_and_whole_table(docs_of, sf0001_docs):
    assert got(docs_of([])) == []
    assert got(sf0001_docs) == brute([(r.doc_id, r.text) for r in sf0001_docs.collect()])


def test_keep_one_of_each_group(docs_of):
    texts = ["the quick brown fox jumps over it"] * 3 + [None, "", "another text altogether, all of it new"]
    df = docs_of(texts).selectExpr("*", "1 AS component_id", "2 AS sig", "3 AS node")
    out = keep_one(df)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == [0, 3, 4, 5]
    twice = keep_one(docs_of(texts + texts, [*range(6), *range(6)]))
    assert sorted(r.doc_id for r in twice.collect()) == [0, 3, 3, 4, 4, 5]


def test_keep_one_tells_rows_apart_by_text(docs_of):
    story = "the quick brown fox jumps over the lazy dog and runs away into the dark wood"
    near, other = story + " again", "an unrelated text of its own that nobody has copied so far"
    third = "one more text that is not like any of the others in here"
    rows = [(1, story), (None, near), (None, other), (None, ""), (None, ""), (2, near), (2, third), (2, ""), (2, ""),
            (7, "x y z"), (7, "x y z"), (7, ""), (7, ""), (None, "p q r"), (None, "P q r")]
    out = keep_one(docs_of([t for _, t in rows], [i for i, _ in rows])).collect()
    left = collections.Counter((r.doc_id, (r.text or "").lower()) for r in out)
    assert left == {(1, story): 1, (None, other): 1, (None, ""): 2, (2, third): 1, (2, ""): 2,
                    (7, "x y z"): 1, (7, ""): 2, (None, "p q r"): 1}


def test_fingerprints_equal_iff_shingles_equal():
    made = random.Random(1)
    texts = [" ".join(made.choice("ab cd é ef\tgh".split(" ")) for _ in range(made.randint(0, 12))) for _ in range(400)]
    sets = Shingler().sets([t.encode().lower() for t in texts])
    for a in range(0, 400, 7):
        for b in range(400):
            same = len(np.intersect1d(sets[a], sets[b]))
            assert same == len(shingles(texts[a]) & shingles(texts[b]))


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 201), (201, 200), (300, 300)]
    out = {r.node: r.label for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert out == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(50)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_bitmaps_bound_the_overlap():
    made = np.random.default_rng(4)
    for _ in range(300):
        n = int(made.integers(1, 400))
        x = np.unique(made.integers(0, 1 << 63, n).astype(np.uint64))
        y = np.unique(np.concatenate([x[made.random(len(x)) < made.random()], made.integers(0, 1 << 63, n // 2 + 1).astype(np.uint64)]))
        bound = jaccard.at_most(jaccard.bitmap(x), len(x), jaccard.bitmap(y), len(y))
        assert bound >= len(np.intersect1d(x, y))
    assert jaccard.at_most(jaccard.bitmap(x), len(x), jaccard.bitmap(x), len(x)) == len(x)


@pytest.mark.parametrize("hot", [0, 3])
def test_similar_sets_meet_at_a_key_that_reaches_both(hot):
    made = np.random.default_rng(11 + hot)
    for _ in range(400):
        n = int(made.integers(2, 130))
        base = made.integers(0, 1 << 63, n).astype(np.uint64)
        sets = []
        for _ in range(2):
            own = made.integers(0, 1 << 63, int(made.integers(0, n // 6 + 1))).astype(np.uint64)
            sets.append(np.unique(np.concatenate([base[made.random(n) > made.random() / 6], own])))
        x, y = sets
        same = len(np.intersect1d(x, y))
        found = [{}, {}]
        for s, out in zip(sets, found):
            keys, _, far = jaccard.prefix_keys(s, (s % np.uint64(4)).astype(np.int64) * hot, np.uint64(7))
            out.update(zip(keys.tolist(), far.tolist()))
        meet = any(len(y) <= found[0][k] and len(x) <= found[1][k] for k in found[0].keys() & found[1].keys())
        if min(len(x), len(y)) > 1 and 100 * same >= 80 * (len(x) + len(y) - same) and not np.array_equal(x, y):
            assert meet


def test_groups_of_edited_copies_against_brute_force(docs_of):
    made = random.Random(3)
    texts = []
    for length in (60, 150):
        base = [f"b{made.randrange(10 ** 6)}" for _ in range(length)]
        for _ in range(60):  # from few edits to so many that a copy links with none or few
            copy = list(base)
            for _ in range(made.randrange(length // 18)):
                copy[made.randrange(len(copy))] = f"e{made.randrange(10 ** 6)}"
            if made.random() < 0.4:
                del copy[made.randrange(len(copy))]
            texts.append(" ".join(copy))
    rows = [*enumerate(texts), *[(None, t + " end") for t in texts[:10]], *[(4, texts[4])] * 3]
    assert got(docs_of([t for _, t in rows], [i for i, _ in rows])) == brute(rows)


def test_whole_sets_are_compared_without_python(spark):
    import hashlib

    from pyspark.sql import functions as F

    words = [f"w{i}" for i in range(104)]  # 100 shingles
    texts = [" ".join(words), " ".join(words[:94] + ["x"] * 10), " ".join(words[:74]), " ".join(words[:84]), "one"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sigs = [(i, hashlib.blake2b(s.tobytes(), digest_size=16).digest())
            for i, s in enumerate(Shingler().sets([t.encode() for t in texts]))]
    classes = docs.join(spark.createDataFrame(sigs, "doc_id long, sig binary"), "doc_id").select(
        (F.col("doc_id") + 10).alias("node"), F.col("doc_id").alias("rep"), F.xxhash64("text").alias("tag"), "sig")
    pairs = spark.createDataFrame([(a, b) for a in range(10, 15) for b in range(a + 1, 15)], "a long, b long")
    linked = jaccard._verified(docs, classes, pairs, jaccard.WORDS, jaccard.PERCENT)
    sets = [shingles(t) for t in texts]
    want = {(a, b) for a in range(5) for b in range(a + 1, 5)
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert {(r.u - 10, r.v - 10) for r in linked.collect()} == want and (0, 3) in want and (0, 2) not in want
    text = linked._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("MapInArrow") == 2  # the sets of both sides; their comparison is an expression


def test_texts_go_to_python_in_small_batches(spark, docs_of, monkeypatch):
    from mortar.llm.text import ARROW_BYTES, _ARROW_CONF

    before, seen = spark.conf.get(_ARROW_CONF), []
    monkeypatch.setattr(jaccard, "cut", lambda df, real=jaccard.cut: (seen.append(spark.conf.get(_ARROW_CONF)), real(df))[1])
    component_digest(docs_of([(1, "a b c d e f"), (2, "a b c d e f"), (3, "x")])).collect()
    assert seen and set(seen) == {str(ARROW_BYTES)} and spark.conf.get(_ARROW_CONF) == before
    spark.conf.set(_ARROW_CONF, "4096")
    try:
        seen.clear()
        component_digest(docs_of([(1, "a b")])).collect()
        assert set(seen) == {"4096"}
    finally:
        spark.conf.set(_ARROW_CONF, before)


def test_later_rounds_take_up_only_what_is_left_of_lists_with_many_pairs(docs_of, monkeypatch):
    made = random.Random(5)
    texts = []
    for size in (6, 6, 6, 40):  # documents that share a passage, of which some are similar
        passage = [f"p{size}x{len(texts)}w{i}" for i in range(70)]
        for _ in range(size):
            own = [f"o{made.randrange(10 ** 9)}" for _ in range(made.choice([4, 12, 20]))]
            texts.append(" ".join(passage + own))
    for name, value in (("SHORT", 2), ("PAIRS", 2), ("FREQUENT", 10 ** 6)):
        monkeypatch.setattr(jaccard, name, value)
    taken, found, real = [], [], jaccard._still_apart

    def counted(rows):
        taken.append(rows.count())
        out = real(rows)
        found.append((out.count(), out.groupBy("key").count().where(f"count > {2 * jaccard.PAIRS + 1}").agg({"count": "sum"}).first()[0] or 0))
        return out

    monkeypatch.setattr(jaccard, "_still_apart", counted)
    assert got(docs_of(texts)) == brute(list(enumerate(texts)))
    assert len(taken) > 1 and all(later <= many < first for later, (_, many), first in zip(taken[1:], found, taken))


def test_the_index_is_removed_when_it_has_been_read(docs_of, monkeypatch):
    import os

    paths, real = [], jaccard.scratch_path
    monkeypatch.setattr(jaccard, "scratch_path", lambda spark, label: (paths.append(real(spark, label)), paths[-1])[1])
    out = jaccard.link_components(docs_of(["a b c d e f", "a b c d e f", "x"]))
    assert len(paths) == 2 and not any(os.path.exists(p.removeprefix("file://").removeprefix("file:")) for p in paths)
    assert sorted((r.doc_id, r.component_id) for r in out.collect()) == [(0, 0), (1, 0), (2, 2)]
