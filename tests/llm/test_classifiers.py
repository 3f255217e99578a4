import itertools
import random
import zlib

import numpy as np
import pytest

from mortar.llm.quality import FactorisationMachine, WordHasher, featurise, quality_digest
from mortar.llm.toxicity import Grammar, keep_clean, learn_insults, toxicity_digest

LABELS = "doc_id long, quality int, toxic int"


def corpus(n=900, seed=3):
    made = random.Random(seed)
    syllables = "ka lo mi ter un da ress vo pin gu".split()

    def word():
        return "".join(made.choice(syllables) for _ in range(made.randint(1, 4)))

    rows, labels = [], []
    for i in range(n):
        toxic, good = made.random() < 0.2, made.random() < 0.8
        text = [word() for _ in range(made.randint(8, 120))]
        for _ in range(3 if toxic else 0):
            text.insert(made.randrange(len(text)), "zorg" + made.choice(["el", "ix", "an", "opt"]))
        text = " ".join(text) if good else " ".join(w.upper() + "!!" for w in text)
        rows.append(text)
        labels.append((i, int(good), int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def tables(spark, docs_of):
    texts, labels = corpus()
    return docs_of([*texts, None, "", "x " * 50_000, texts[0]], [*range(len(texts)), 5001, 5002, 5003, 0]), \
        spark.createDataFrame([*labels, (0, None, None), (None, 1, 1), (99_999, 0, 1)], LABELS), labels


def accuracy(rows, truth, remainder, modulus):
    held = {r.doc_id: r for r in rows if r.held_out}
    assert all((zlib.crc32(str(r.doc_id).encode()) % modulus == remainder) == r.held_out for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    return np.mean([held[i].predicted == y for i, y in truth.items() if i in held])


def test_toxicity_on_held_out_rows(tables):
    docs, labels, truth = tables
    rows = toxicity_digest(docs, labels).collect()
    assert len(rows) == docs.count()
    assert accuracy(rows, {i: t for i, _, t in truth}, 2, 4) > 0.98
    clean = keep_clean(docs.selectExpr("*", "1 AS score", "2 AS label"), docs, labels)
    assert {"score", "label"} <= set(clean.columns)
    assert clean.count() == sum(r.predicted == 0 for r in rows)


def test_quality_on_held_out_rows(tables):
    docs, labels, truth = tables
    rows = quality_digest(docs, labels).collect()
    assert len(rows) == docs.count()
    assert accuracy(rows, {i: q for i, q, _ in truth}, 0, 5) > 0.95


def test_no_labels_and_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], LABELS)
    docs = docs_of(["you are an idiot", "a fine day", None])
    assert {r.doc_id: r.predicted for r in toxicity_digest(docs, none).collect()} == {0: 1, 1: 0, 2: 0}
    assert {r.score for r in quality_digest(docs, none).collect()} == {0.5}
    assert toxicity_digest(docs_of([]), none).count() == quality_digest(docs_of([]), none).count() == 0


def test_grammar_scores_clauses():
    g = Grammar({"idiot": 2.0, "zorg*": 2.0})
    weight = lambda text: sum(w for _, w in g.clause(text.split()))
    assert weight("you are an idiot") > weight("what an idiot") > weight("not an idiot") > 0
    assert weight("he said you are an idiot") < weight("you are an idiot")
    assert weight("i will kill you") > weight("they wrote never kill") > 0
    assert weight("zorgling here") == 2.0 and weight("a fine day") == 0
    assert g.features("A fine day. Nothing else!")[:5] == [0, 0, 0, 0, 0]


def test_grammar_against_enumerated_clauses():
    """Every clause of up to six words over one word of each kind."""
    g = Grammar({"idiot": 2.0})
    for n in range(7):
        for words in itertools.product("x idiot kill you not said".split(), repeat=n):
            want = []
            for i, word in enumerate(words):
                if word not in ("idiot", "kill"):
                    continue
                near = [*words[max(i - 3, 0):i], *words[i + 1:i + 4]]
                aimed = "you" in near or (word == "kill" and "idiot" in near)
                weight = 2.0 * (0.4 if "not" in words[max(i - 2, 0):i] else 1) * (0.6 if "said" in words[:i] else 1)
                if aimed:
                    want.append((2 if word == "kill" else 1, weight * 1.5))
                elif word == "idiot":
                    want.append((0, weight))
            found = g.clause(list(words))
            assert sorted((k, round(w, 9)) for k, w in found) == sorted((k, round(w, 9)) for k, w in want), words


def test_threats_need_a_target():
    g = Grammar({"idiot": 2.0})
    for text in ("Kill the process.", "Burn the file to disk; shoot a film", "kill. you", "hurt " * 1000):
        assert g.features(text) == [0] * 5
    assert g.features("I will hurt you")[2] > 0 and g.features("burn that idiot")[2] > 0
    assert len(g.clause(["idiot"] * 5000)) == 5000


def test_copies_of_one_toxic_text_teach_nothing(spark):
    made = random.Random(5)
    rows = [(" ".join(f"w{made.randint(0, 5000)}" for _ in range(30)), 0) for _ in range(400)]
    rows += [("odd unique sentence that is copied over and over again", 1)] * 60
    rows += [(" ".join([f"w{made.randint(0, 5000)}", "gronk", f"w{made.randint(0, 5000)}"]), 1) for _ in range(40)]
    learnt = learn_insults(spark.createDataFrame(rows, "text string, label int"))
    assert set(learnt) == {"gronk"}


def test_sum_of_squares_identity():
    model = FactorisationMachine(slots=64, factors=3, seed=1)
    model.w[:] = np.random.default_rng(2).normal(size=len(model.w))
    slots, stats = featurise([b"one two three TWO", b"", "é x1 9".encode()], WordHasher(64))
    index, value, begin = model.rows(slots, stats)
    z = model.forward(index, value, begin)[0]
    ends = [*begin[1:], len(index)]
    for row, (a, b) in enumerate(zip(begin, ends)):
        x, i = value[a:b], index[a:b]
        pairs = sum((model.v[i[p]] @ model.v[i[q]]) * x[p] * x[q] for p in range(len(i)) for q in range(p))
        assert np.isclose(z[row], model.w[i] @ x + pairs)


def test_the_sample_bound_holds_for_repeated_ids(spark, docs_of):
    from mortar.llm.labelled import training_rows
    docs = docs_of([f"text {i % 7}" for i in range(3000)], [i % 3 for i in range(3000)])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(3)], "doc_id long, quality int, toxic int")
    rows = training_rows(docs, labels, "quality", (5, 9), 2).collect()
    assert len(rows) == 2
    assert sorted(rows) == sorted(
        training_rows(docs.repartition(5), labels, "quality", (5, 9), 2).collect())


def test_texts_are_scored_in_small_batches(spark, tables, monkeypatch):
    from mortar.llm import toxicity
    from mortar.llm.text import ARROW_BYTES, _ARROW_CONF

    before, seen, real = spark.conf.get(_ARROW_CONF), [], toxicity.cut
    monkeypatch.setattr(toxicity, "cut", lambda df: (seen.append((spark.conf.get(_ARROW_CONF), df.columns)), real(df))[1])
    docs, labels = tables[:2]
    plan = keep_clean(docs, docs, labels)._jdf.queryExecution().optimizedPlan().toString()
    assert seen[-1] == (str(ARROW_BYTES), ["_text"]) and spark.conf.get(_ARROW_CONF) == before
    assert "MapInArrow" not in plan  # whole rows do not go to Python
