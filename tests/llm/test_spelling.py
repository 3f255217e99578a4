import random
import re
import zlib
from collections import Counter

from mortar.llm.spelling import near_pairs, variant_digest, variants, word_counts

from .conftest import A_TO_Z

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def count(rows, slip=31):
    out = Counter()
    for i, t in rows:
        for run in RUN.findall(t or ""):
            word = run.translate(A_TO_Z)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if slip and h % slip == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1:]
            out[word] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = (a, b) if len(a) > len(b) else (b, a)
    return any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute(words, ratio=10):
    form, out = {}, []
    for w, n in words.items():
        close = sorted((-words[x], x) for x in words if near(w, x))
        best = close[0] if close and -close[0][0] >= ratio * n else None
        form[w] = best and best[1]
        out.append([w, best and best[1], None, n, len(close), best and -best[0]])
    for r in out:
        root = r[0]
        while form[root]:
            root = form[root]
        r[2] = root
    return sorted(tuple(r) for r in out)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "w", 1) for i, t in rows], "doc_id long, text string, word string, n long")


def test_edges_against_brute_force(spark):
    made = random.Random(5)
    stems = ["therefore", "abbbbbbbc", "aaaaaaaa", "zyxwvut", "élèvement", "ÀÉÎÕÜàéîõü", "abcdefgh"]
    rows = []
    for i in range(300):
        words = []
        for stem in stems:
            for _ in range(made.randint(0, 6)):
                w = list(stem)
                if made.random() < 0.2:
                    at = made.randrange(len(w))
                    kind = made.randrange(3)
                    w[at:at + 1] = [[], [made.choice("abbé")], [w[at], made.choice("abbé")]][kind]
                words.append("".join(w).upper() if made.random() < 0.1 else "".join(w))
        rows.append((i, " ".join(words) + "-it's 1×÷2"))
    rows += [(None, "therefore therefore"), (400, None), (401, ""), (402, "x" * 3000 + " " + "x" * 3000), (1, "zyxwvut"),
             (403, "x" * 3001 + " " + "x" * 3001)]
    assert sorted(tuple(r) for r in variant_digest(frame(spark, rows)).collect()) == brute(count(rows))
    plain = {r.word: r.n for r in word_counts(frame(spark, rows), slip=None).collect()}
    assert plain == count(rows, None)
    assert variant_digest(frame(spark, [])).collect() == []


def test_every_pair_once(spark):
    made = random.Random(6)
    words = {"".join(made.choice("ab") for _ in range(made.randint(7, 10))) for _ in range(400)}
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    got = [tuple(sorted((r.a, r.b))) for r in near_pairs(df).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(a, b) for a in words for b in words if a < b and near(a, b)}


def test_chains_of_forms(spark):
    words = {"aaaaaaa": 10 ** 7, "aaaaaab": 10 ** 6, "aaaaabb": 10 ** 5, "aaaabbb": 10 ** 4, "aaabbbb": 1000,
             "aabbbbb": 100, "abbbbbb": 10, "bbbbbbb": 1, "cbbbbbb": 10, "xyzxyzx": 5}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert sorted(tuple(r) for r in variants(df).collect()) == brute(words)


def test_whole_small_table(spark, sf0001_docs):
    rows = [(r.doc_id, r.text) for r in sf0001_docs.collect()]
    assert sorted(tuple(r) for r in variant_digest(sf0001_docs).collect()) == brute(count(rows))
