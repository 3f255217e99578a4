import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

from pyspark.sql import functions as F

from mortar.llm.mixing import measured, mix, mix_digest, mix_plan, mixed_texts, targets

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string, size int, _src string"


def level(sizes, weights=(5, 2, 1), epochs=3):
    """{source: target} by clamping and resharing, in exact fractions."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, out = sum(sizes.values()), {}
    while True:
        left = [s for s in order if s not in out]
        free = total - sum(out.values())
        shares = {s: Fraction(free * weight[s], sum(weight[x] for x in left)) for s in left}
        above = [s for s in left if shares[s] > epochs * sizes[s]]
        if not above:
            return {**out, **shares}
        out.update({s: Fraction(epochs * sizes[s]) for s in above})


def brute(rows, **p):
    """Sorted (doc_id, size, source_size, target, taken) row by row."""
    sizes = defaultdict(int)
    for i, t, s in rows:
        sizes[s] += len(WORDS.findall(t or ""))
    goal, out = level(sizes, **p), []
    for s in sizes:
        words = int(goal[s])
        whole, rest = divmod(words, sizes[s]) if sizes[s] else (0, 0)
        mine = []
        for i, t, x in rows:
            if x == s:
                said = f"mix-1:{'' if i is None else i}:{t or ''}"
                mine.append((hashlib.md5(said.encode()).hexdigest(), len(WORDS.findall(t or "")), i))
        for key, n, i in sorted(mine, key=lambda m: (m[0], m[1], str(m[2]))):
            extra = max(0, min(n, rest))
            rest -= extra
            out.append((i, n, sizes[s], float(goal[s]), whole * n + extra))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, 9, "x") for i, t, s in rows], SCHEMA)


def cases():
    rows = [(i, "w " * (i % 13), f"s{i % 7}") for i in range(60)]
    rows += [(100 + i, "one two three", "big") for i in range(80)]
    rows += [(200, None, "s1"), (201, "", "s2"), (202, " \t\n", None), (None, "a b c", None), (203, "long " * 5000, "s3")]
    rows += [(300, "x", "tiny"), (301, "Ünïcödé joined words", "Ä"), (302, "q", "empty"), (303, "", "nothing")]
    return rows


def test_edges_against_brute_force(spark):
    rows = cases()
    got = sorted([tuple(r) for r in mix_digest(frame(spark, rows)).collect()], key=str)
    assert got == brute(rows)
    assert sum(r[4] for r in got) >= sum(r[1] for r in got) - len(rows)  # all words are shared out
    assert all(r[4] <= 3 * r[1] for r in got)
    assert mix_digest(frame(spark, [])).collect() == []
    nothing = mix_digest(frame(spark, [(1, "", "a"), (2, None, None)])).collect()
    assert sorted(tuple(r) for r in nothing) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_repeated_rows_on_the_border(spark):
    # the border lies inside a third of all rows that are alike; their count is met all the same
    rows = [(7, "w", "b")] * 300 + [(None, None, "b")] * 50 + [(i, "a b c d", "a") for i in range(150)]
    got = Counter(tuple(r) for r in mix_digest(frame(spark, rows).repartition(7)).collect())
    assert got == Counter(brute(rows))
    assert got == Counter(tuple(r) for r in mix_digest(frame(spark, rows).repartition(3)).collect())


def test_many_sources_clamp_in_rounds(spark):
    sizes = {f"s{i:03d}": 2 ** (i % 40) + i for i in range(200)} | {"zero": 0}
    df = spark.createDataFrame([("+" + s, n) for s, n in sizes.items()], "_src string, _source_size long")
    goal = level(sizes)
    for r in targets(df).collect():
        exact = goal[r._src[1:]]
        assert r._words == int(exact) and abs(r._target - float(exact)) <= 1e-9 * max(1.0, float(exact))


def test_mix_texts_and_columns(spark):
    rows = cases()
    out = mix(frame(spark, rows))
    assert out.columns == ["doc_id", "text", "source", "_src", "size", "source_size", "target", "taken", "repeats",
                           "part_words"]
    copies = mixed_texts(out.where("doc_id is not null")).select("doc_id", F.col("text"), "copy").collect()
    words = Counter()
    for r in copies:
        words[r.doc_id] += len(WORDS.findall(r.text))
    taken = {r.doc_id: r.taken for r in out.collect() if r.doc_id is not None and r.taken}
    assert dict(words) == taken


def test_whole_small_table(spark, sf0001_docs):
    rows = [(r.doc_id, r.text, r.source) for r in sf0001_docs.collect()]
    assert sorted([tuple(r) for r in mix_digest(sf0001_docs).collect()], key=str) == brute(rows)


def test_plan_runs_no_python(spark, sf0001_docs):
    rows = measured(sf0001_docs)
    plan = rows.join(mix_plan(rows.select("_src", "_size", "_key")), "_src")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
