"""Toxicity by a weighted grammar of finite-state transducers.

A lexicon transducer turns words into weighted symbols (insult, threat,
target, negation, report).  Its output goes through a composition of three
transducers: negation and reported speech weigh the insults and threats in
their scope down, and the clause grammar accepts insults and threats with
their target (``clauses``).  A document's score is a logistic function of its
accepted clauses; a threat word that is aimed at nobody ("kill the process")
is none.

Insult words and stems are learnt from labelled rows (at most ``TRAIN_ROWS``):
terms whose distinct contexts lie almost all in toxic documents, so that many
copies of one document are one piece of evidence.  The logistic function is
fitted on the same rows.

Defined cases: null and empty texts have no clause and get the score of a
text without one; texts of any length are read whole; without any label the
built-in words alone are used; other input columns pass through.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

from .labelled import held_out, training_rows
from .text import broadcast_if_small, cut, fingerprint, small_batches

# Workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# --- fixed values: built-in words ----------------------------------------------
INSULTS = "idiot moron scum imbecile stupid worthless pathetic disgusting loser trash arschloch idiota connard".split()
THREATS = "kill murder hurt destroy strangle shoot stab burn töten umbringen tuer matar".split()
TARGETS = """you your yours yourself u he she they them these those people everyone du dich dir ihr euch sie tu toi te
vous votre tú te usted ustedes""".split()
NEGATIONS = "not never no isn't aren't don't won't cannot nicht kein keine nie pas jamais nunca".split()
REPORTS = "said says say wrote writes called calls claimed quoted sagte schrieb dit écrit dijo escribió".split()
# --- end of fixed values ----------------------------------------------------------

HELD_OUT = (4, 2)
THRESHOLD = 0.3
TRAIN_ROWS = 10_000
# A learnt term: distinct contexts, share of them in toxic rows, association.
MIN_CONTEXTS = 5
PURITY = 0.95
MIN_G2 = 24.0
STEMS = range(3, 9)
SHARE_OF_STEM = 0.9

WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
CLAUSE = re.compile(r"[.!?;:\n\r]+")
PLAIN, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
LABELS = ("insult", "aimed insult", "aimed threat")
BARE_INSULT, AIMED_INSULT, AIMED_THREAT = range(3)
AIMED, NEGATED, REPORTED = 1.5, 0.4, 0.6
# Words between which a target is near, and words that a negation weighs down.
REACH, NEGATION_REACH = 3, 2
TABLE = 100_000


class Transducer:
    """Finite-state: ``arcs(state, symbol)`` gives (state, outputs), ``end(state)`` the outputs at the end of a clause."""

    def __init__(self, start, arcs, end=lambda state: ()):
        self.start, self.arcs, self.end = start, arcs, end


def scope(opener: int, reach: int | None, factor: float) -> Transducer:
    """Weighs insults and threats down by ``factor`` for ``reach`` words (None: the whole clause) after ``opener``."""
    def arcs(left, symbol):
        kind, weight = symbol
        if kind == opener:
            return reach or 1, ((PLAIN, 0.0),)
        if left and kind in (INSULT, THREAT):
            symbol = kind, weight * factor
        return (left if reach is None else max(left - 1, 0)), (symbol,)
    return Transducer(0, arcs)


def clauses() -> Transducer:
    """Accepts the clauses that count; outputs (label, weight) of each.

    An insult or a threat is aimed when a target, or for a threat also an
    insult, stands within ``REACH`` words on either side.  Accepting: aimed
    insult, aimed threat, and the insult without a target (a call, a verdict).
    A threat word that is aimed at nobody is no clause.

    State: words for which the last target, the last insult are still near,
    and the insults and threats that wait for one.
    """
    def bare(waiting):
        return tuple((BARE_INSULT, w) for kind, w, _ in waiting if kind == INSULT)

    def arcs(state, symbol):
        target, insult, waiting = state
        kind, weight = symbol
        out = ()
        if kind == TARGET:
            out = tuple((AIMED_THREAT if k == THREAT else AIMED_INSULT, w * AIMED) for k, w, _ in waiting)
            waiting = ()
        elif kind == INSULT:
            out = tuple((AIMED_THREAT, w * AIMED) for k, w, _ in waiting if k == THREAT)
            waiting = tuple(x for x in waiting if x[0] == INSULT)
        over = tuple(x for x in waiting if x[2] == 1)
        waiting = tuple((k, w, left - 1) for k, w, left in waiting if left > 1)
        out += bare(over)
        if kind == INSULT and target:
            out += ((AIMED_INSULT, weight * AIMED),)
        elif kind == THREAT and (target or insult):
            out += ((AIMED_THREAT, weight * AIMED),)
        elif kind in (INSULT, THREAT):
            waiting += ((kind, weight, REACH),)
        target = REACH if kind == TARGET else max(target - 1, 0)
        insult = REACH if kind == INSULT else max(insult - 1, 0)
        return (target, insult, waiting), out

    return Transducer((0, 0, ()), arcs, lambda state: bare(state[2]))


def compose(first: Transducer, then: Transducer) -> Transducer:
    """What ``first`` puts out is what ``then`` reads; a state is a pair of theirs."""
    def read(state, symbols):
        out = []
        for symbol in symbols:
            state, made = then.arcs(state, symbol)
            out += made
        return state, out

    def arcs(state, symbol):
        a, middle = first.arcs(state[0], symbol)
        b, out = read(state[1], middle)
        return (a, b), tuple(out)

    def end(state):
        b, out = read(state[1], first.end(state[0]))
        return (*out, *then.end(b))

    return Transducer((first.start, then.start), arcs, end)


def tabled(machine: Transducer) -> Transducer:
    """``machine`` with its arcs kept as they are met, at most ``TABLE`` of them."""
    table: dict = {}

    def arcs(state, symbol):
        found = table.get((state, symbol))
        if found is None:
            if len(table) >= TABLE:
                table.clear()
            found = table[state, symbol] = machine.arcs(state, symbol)
        return found

    return Transducer(machine.start, arcs, machine.end)


class Grammar:
    def __init__(self, insults: dict[str, float]):
        """``insults``: weight of words, and of stems marked by a final ``*``."""
        self.words = {w: (TARGET, 1.0) for w in TARGETS}
        self.words |= {w: (NEGATION, 1.0) for w in NEGATIONS} | {w: (REPORT, 1.0) for w in REPORTS}
        self.words |= {w: (THREAT, 2.0) for w in THREATS}
        self.words |= {w: (INSULT, x) for w, x in insults.items() if not w.endswith("*")}
        self.stems = {w[:-1]: x for w, x in insults.items() if w.endswith("*")}
        self.lengths = sorted({len(s) for s in self.stems})
        anchors = [w for w, (s, _) in self.words.items() if s in (INSULT, THREAT)] + list(self.stems)
        self.heads = {a[:3] for a in anchors}
        self.machine = tabled(compose(
            scope(NEGATION, NEGATION_REACH, NEGATED), compose(scope(REPORT, None, REPORTED), clauses())))

    def symbol(self, word: str) -> tuple[int, float]:
        found = self.words.get(word)
        if found:
            return found
        for n in self.lengths:
            weight = self.stems.get(word[:n])
            if weight is not None:
                return INSULT, weight
        return PLAIN, 0.0

    def clause(self, words: list[str]) -> list[tuple[int, float]]:
        """(label, weight) of what the grammar accepts in the clause."""
        state, found = self.machine.start, []
        for word in words:
            state, out = self.machine.arcs(state, self.symbol(word))
            found += out
        return [*found, *self.machine.end(state)]

    def features(self, text: str) -> list[float]:
        """Summed weight by label, the heaviest clause, and matches per hundred words (logs)."""
        text, heads = text.lower(), self.heads
        words = WORD.findall(text)
        sums, most, count = [0.0] * len(LABELS), 0.0, 0
        if any(w[:3] in heads for w in words):
            for clause in CLAUSE.split(text):
                inside = WORD.findall(clause)
                if any(w[:3] in heads for w in inside):
                    found = self.clause(inside)
                    for label, weight in found:
                        sums[label] += weight
                    count += len(found)
                    most = max(most, sum(w for _, w in found))
        return [*np.log1p(sums), np.log1p(most), np.log1p(100 * count / max(len(words), 1))]


def _terms(word: str) -> list[str]:
    return [word, *[word[:n] + "*" for n in STEMS if n < len(word)]]


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[str, list[int]] = {}
        for text, label in zip(batch.column("text"), batch.column("label")):
            kind = int(label.as_py() > 0)
            for term in {t for w in set(WORD.findall(text.as_py().lower())) for t in _terms(w)}:
                counts.setdefault(term, [0, 0])[kind] += 1
        yield pa.RecordBatch.from_arrays([
            pa.array(list(counts), pa.string()), pa.array([c[1] for c in counts.values()], pa.int64()),
            pa.array([c[0] for c in counts.values()], pa.int64())], names=["term", "pos", "neg"])


def _association(pos: np.ndarray, neg: np.ndarray, base: float) -> np.ndarray:
    """G2 of a term's share of toxic evidence against the base rate."""
    n = pos + neg
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(pos > 0, pos * np.log(pos / (n * base)), 0)
        b = np.where(neg > 0, neg * np.log(neg / (n * (1 - base))), 0)
    return 2 * (a + b)


def learn_insults(rows: DataFrame) -> dict[str, float]:
    """Words and stems (``stem*``) with weights, from (text, label) rows."""
    size = rows.agg(F.count(F.lit(1)), F.sum("label")).first()
    n, positive = size[0], size[1] or 0
    if not 0 < positive < n:
        return {}
    base = positive / n
    schema = "term string, pos long, neg long"
    counted = rows.mapInArrow(_count_terms, schema).groupBy("term").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    table = counted.where((F.col("pos") >= 3) & (F.col("pos") >= 4 * F.col("neg"))).toArrow()
    pos, neg = (table.column(c).to_numpy().astype(float) for c in ("pos", "neg"))
    strong = _association(pos, neg, base) >= MIN_G2 / 2
    short_list = set(np.array(table.column("term").to_pylist(), dtype=object)[strong])
    if not short_list:
        return {}
    shared = rows.sparkSession.sparkContext.broadcast(short_list)

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = shared.value
        for batch in batches:
            seen = set()
            for text, label in zip(batch.column("text"), batch.column("label")):
                words = ["", *WORD.findall(text.as_py().lower()), ""]
                for i in range(1, len(words) - 1):
                    for term in _terms(words[i]):
                        if term in listed:
                            seen.add((term, words[i - 1] + " " + words[i + 1], int(label.as_py() > 0)))
            cols = list(zip(*seen)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int32())],
                names=["term", "context", "label"])

    evidence = (
        rows.mapInArrow(contexts, "term string, context string, label int")
        .groupBy("term", "context").agg(F.min("label").alias("label"))
        .groupBy("term").agg(F.sum("label").cast("long").alias("pos"),
                             F.sum(1 - F.col("label")).cast("long").alias("neg")).toArrow())
    terms = evidence.column("term").to_pylist()
    pos, neg = (evidence.column(c).to_numpy().astype(float) for c in ("pos", "neg"))
    good = (pos >= MIN_CONTEXTS) & (pos >= PURITY * (pos + neg)) & (_association(pos, neg, base) >= MIN_G2)
    support = {t: (p, q) for t, p, q, g in zip(terms, pos, neg, good) if g}
    # of a stem and its continuations: the longest one that keeps the evidence, else the stem
    chosen: dict[str, float] = {}
    for term in sorted(support, key=lambda t: (len(t.rstrip("*")), t)):
        stem = term.rstrip("*")
        if any(stem[:k] + "*" in chosen for k in range(len(stem) + 1)):
            continue
        best = term
        if term.endswith("*"):
            for other in support:
                if (other.startswith(stem) and len(other.rstrip("*")) > len(best.rstrip("*")) - (best == term)
                        and support[other][0] >= SHARE_OF_STEM * support[term][0]):
                    if len(other.rstrip("*")) > len(best.rstrip("*")) or not other.endswith("*"):
                        best = other
        p, q = support[best]
        chosen[best] = float(min(4.0, np.log((p + 0.5) / (q + 0.5)) - np.log(base / (1 - base)))) / 2
    return chosen


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-2) -> np.ndarray:
    """Weights with the intercept last; Newton steps with a small ridge."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + (ridge + 1e-9) * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


# Where there is nothing to fit on: any matched clause passes the threshold.
DEFAULT_WEIGHTS = [1.0, 1.5, 2.0, 1.0, 0.5, -3.0]


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", limit: int = TRAIN_ROWS) -> tuple[dict, list]:
    """(insult weights, logistic weights) from at most ``limit`` labelled rows that are not held out."""
    rows = training_rows(docs, labels, label, HELD_OUT, limit)
    insults = {w: 1.5 for w in INSULTS} | learn_insults(rows)
    shared = rows.sparkSession.sparkContext.broadcast(insults)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(shared.value)
        for batch in batches:
            made = [grammar.features(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(made, pa.list_(pa.float64())), batch.column("label")], names=["x", "label"])

    table = rows.mapInArrow(features, "x array<double>, label int").toArrow()
    y = table.column("label").to_numpy() > 0
    if not 0 < y.sum() < len(y):
        return insults, DEFAULT_WEIGHTS
    x = np.array(table.column("x").to_pylist())
    return insults, fit_logistic(x, y.astype(float)).tolist()


def score_texts(docs: DataFrame, model: tuple[dict, list]) -> DataFrame:
    """``docs`` plus ``score`` (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    taken = [f for f in docs.schema.fields if f.name.lower() != "score"]
    schema = T.StructType([*taken, T.StructField("score", T.DoubleType())])
    text_at = [f.name for f in taken].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        insults, weights = shared.value
        grammar, weights = Grammar(insults), np.array(weights)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array([grammar.features(t.as_py() or "") for t in batch.column(text_at)])
            z = np.clip(x @ weights[:-1] + weights[-1], -30, 30)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(1 / (1 + np.exp(-z)))], names=[f.name for f in schema.fields])

    return docs.select(*[F.col(f.name) for f in taken]).mapInArrow(run, schema)


def toxicity_digest(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> DataFrame:
    """The contract's columns: doc_id, held_out, score, predicted."""
    model = train(docs, labels, limit=limit)
    scored = score_texts(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id"), *HELD_OUT).alias("held_out"), "score",
                         F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def keep_clean(docs: DataFrame, train_docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` without those that score THRESHOLD or more."""
    model = train(train_docs, labels, limit=limit)
    # a score is the text's own, so the rejected texts tell the rows: these alone are written, in small batches
    mark = fingerprint(F.coalesce("text", F.lit("")))
    with small_batches(docs.sparkSession):
        gone = cut(score_texts(docs.select("text"), model).where(F.col("score") >= THRESHOLD).select(
            mark.alias("_text")).distinct())
    return docs.join(broadcast_if_small(gone), mark == F.col("_text"), "left_anti")
