"""Quality classifier: a factorisation machine over hashed words and statistics.

Every text becomes a sparse vector: its distinct words, hashed and scaled to
unit length, and structure statistics of its bytes, lines and words (and the
length given as metadata).  The score is

    w0 + sum w_i x_i + 1/2 sum_f [ (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2 ]

through the logistic function: all pairwise interactions in time linear in
the words, by the sum-of-squares identity.  The model (a fixed number of
hash slots) is fitted on at most ``TRAIN_ROWS`` labelled rows.

Defined cases: null and empty texts have the statistics of an empty text
and are scored like any other; texts of any length are read whole; without
labels of both kinds every score is the share of good rows (0.5 without any).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from .jaccard import CHUNK_BYTES, _mix
from .labelled import held_out, training_rows

# Workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HELD_OUT = (5, 0)
THRESHOLD = 0.3
TRAIN_ROWS = 8_000
SLOTS = 1 << 16
FACTORS = 8
EPOCHS = 12
BATCH = 64
RATE = 0.05
WORD_DECAY = 3e-3

_U = np.uint64


class WordHasher:
    """Slots of the words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of many lower-cased texts at once."""

    def __init__(self, slots: int = SLOTS):
        self.slots = slots
        self.letters = _mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
        self.word = np.ones(256, bool)
        self.word[0:0x30] = self.word[0x3A:0x61] = self.word[0x7B:0x80] = False
        self.power = self.inverse = np.ones(1, _U)

    def slots_of(self, texts: list[bytes]) -> list[np.ndarray]:
        data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        if len(self.power) <= len(data):
            base = 0x2545F4914F6CDD1D
            n = max(len(data) + 1, 2 * CHUNK_BYTES)
            for name, factor in (("power", base), ("inverse", pow(base, -1, 1 << 64))):
                steps = np.full(n, factor, _U)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=_U))
        edge = np.diff(self.word[data].astype(np.int8), prepend=0, append=0)
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sums = np.zeros(len(data) + 1, _U)
        np.cumsum(self.letters[data] * self.power[:len(data)], out=sums[1:])
        slots = (_mix((sums[end] - sums[begin]) * self.inverse[begin]) % _U(self.slots)).astype(np.int64)
        stops = np.searchsorted(begin, np.cumsum([len(t) + 1 for t in texts]))
        return np.split(slots, stops[:-1])


def statistics(raw: bytes, words: np.ndarray, distinct: int) -> np.ndarray:
    """Structure statistics of one text (bytes as they are, not lower-cased)."""
    data = np.frombuffer(raw, np.uint8)
    n = max(len(data), 1)
    kinds = np.bincount(data, minlength=256)
    upper, lower = kinds[65:91].sum(), kinds[97:123].sum()
    lines = raw.split(b"\n")
    filled = [x for x in (line.strip() for line in lines) if x]
    longest = max(map(len, filled), default=0)
    tokens = raw.split()
    repeats = 1 - len(set(filled)) / max(len(filled), 1)
    return np.array([
        1.0,
        np.log1p(len(data)) / 10, np.log1p(len(words)) / 10,
        upper / max(upper + lower, 1), kinds[48:58].sum() / n * 4, kinds[128:].sum() / n,
        kinds[33] / n * 10, (kinds[35] + kinds[36] + kinds[37] + kinds[38] + kinds[42]) / n * 4,
        kinds[124] / n * 10, (kinds[60] + kinds[62] + kinds[123] + kinds[125]) / n * 10,
        (kinds[47] + kinds[58] + kinds[64]) / n * 10, (kinds[44] + kinds[46]) / n * 10, kinds[32] / n,
        repeats, np.log1p(len(lines)) / 5, np.log1p(longest) / 10,
        distinct / max(len(words), 1), len(set(tokens)) / max(len(tokens), 1),
        sum(t[-1:] in b"!*#$%&|" for t in tokens) / max(len(tokens), 1),
        sum(t == b"|" for t in tokens) / max(len(tokens), 1),
        float(len(words) < 5),
    ])


N_STATISTICS = len(statistics(b"", np.zeros(0), 0))


def featurise(texts: list[bytes], hasher: WordHasher) -> tuple[list[np.ndarray], np.ndarray]:
    """(distinct word slots of each text, matrix of statistics)."""
    slots, stats = [], []
    for raw, own in zip(texts, hasher.slots_of([t.lower() for t in texts])):
        distinct = np.unique(own)
        slots.append(distinct)
        stats.append(statistics(raw, own, len(distinct)))
    return slots, np.array(stats)


class FactorisationMachine:
    """Parameters of word slots, then of statistics; both with linear weights and factors."""

    def __init__(self, slots: int = SLOTS, factors: int = FACTORS, seed: int = 7):
        made = np.random.default_rng(seed)
        size = slots + N_STATISTICS
        self.slots = slots
        self.w = np.zeros(size)
        self.v = made.normal(0, 0.05, (size, factors))
        self.mean, self.scale = np.zeros(N_STATISTICS), np.ones(N_STATISTICS)

    def rows(self, slots: list[np.ndarray], stats: np.ndarray):
        """Flat (index, value, begin) of the sparse rows."""
        z = np.clip((stats - self.mean) / self.scale, -5, 5)
        z[:, 0] = 1
        index = [np.concatenate([s, self.slots + np.arange(N_STATISTICS)]) for s in slots]
        value = [np.concatenate([np.full(len(s), 1 / np.sqrt(max(len(s), 1))), r / np.sqrt(N_STATISTICS)])
                 for s, r in zip(slots, z)]
        begin = np.concatenate(([0], np.cumsum([len(i) for i in index])[:-1]))
        return np.concatenate(index), np.concatenate(value), begin

    def forward(self, index, value, begin):
        vx = self.v[index] * value[:, None]
        total = np.add.reduceat(vx, begin)
        squares = np.add.reduceat(vx * vx, begin)
        linear = np.add.reduceat(self.w[index] * value, begin)
        return linear + 0.5 * (total ** 2 - squares).sum(1), total, vx

    def scores(self, slots: list[np.ndarray], stats: np.ndarray) -> np.ndarray:
        z = self.forward(*self.rows(slots, stats))[0]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def fit(self, slots: list[np.ndarray], stats: np.ndarray, y: np.ndarray, epochs: int = EPOCHS) -> None:
        """Adagrad steps on the log loss, both classes of equal weight near the threshold."""
        self.mean, self.scale = stats.mean(0), stats.std(0) + 1e-6
        made = np.random.default_rng(11)
        past_w, past_v = np.full(self.w.shape, 1e-6), np.full(self.v.shape, 1e-6)
        for _ in range(epochs):
            order = made.permutation(len(y))
            for at in range(0, len(y), BATCH):
                some = order[at:at + BATCH]
                index, value, begin = self.rows([slots[i] for i in some], stats[some])
                z, total, vx = self.forward(index, value, begin)
                error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[some]) / len(some)
                counts = np.diff(np.append(begin, len(index)))
                e = np.repeat(error, counts)
                grad_v = e[:, None] * value[:, None] * (np.repeat(total, counts, 0) - vx)
                used, back = np.unique(index, return_inverse=True)
                gw = np.bincount(back, e * value, len(used))
                gv = np.zeros((len(used), self.v.shape[1]))
                np.add.at(gv, back, grad_v)
                decay = np.where(used < self.slots, WORD_DECAY, 1e-5)
                gw += decay * self.w[used]
                gv += decay[:, None] * self.v[used]
                past_w[used] += gw ** 2
                past_v[used] += gv ** 2
                self.w[used] -= RATE * gw / np.sqrt(past_w[used])
                self.v[used] -= RATE * gv / np.sqrt(past_v[used])


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    texts, first, size = [], 0, 0
    for row, t in enumerate(batch.column("text").cast(pa.binary())):
        texts.append(t.as_py() or b"")
        size += len(texts[-1])
        if size >= CHUNK_BYTES:
            yield first, texts
            texts, first, size = [], row + 1, 0
    if texts:
        yield first, texts


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", limit: int = TRAIN_ROWS) -> dict:
    """Model parameters as plain arrays, from at most ``limit`` labelled rows that are not held out."""
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            for first, texts in _chunks(batch):
                slots, stats = featurise(texts, hasher)
                yield pa.RecordBatch.from_arrays([
                    pa.array(slots, pa.list_(pa.int64())), pa.array(list(stats), pa.list_(pa.float64())),
                    batch.column("label").slice(first, len(texts))], names=["slots", "stats", "label"])

    rows = training_rows(docs, labels, label, HELD_OUT, limit)
    table = rows.mapInArrow(features, "slots array<long>, stats array<double>, label int").toArrow()
    y = (table.column("label").to_numpy() > 0).astype(float)
    if not 0 < y.sum() < len(y):
        return {"constant": float(y.mean()) if len(y) else 0.5}
    slots = [np.array(s.as_py(), np.int64) for s in table.column("slots")]
    model = FactorisationMachine()
    model.fit(slots, np.array(table.column("stats").to_pylist()), y)
    return {"w": model.w.astype(np.float32), "v": model.v.astype(np.float32), "mean": model.mean,
            "scale": model.scale}


def quality_scores(docs: DataFrame, parameters: dict) -> DataFrame:
    """(doc_id, score) of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(parameters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, given = WordHasher(), shared.value
        model = FactorisationMachine(SLOTS)
        for name in given:
            setattr(model, name, given[name])
        for batch in batches:
            for first, texts in _chunks(batch):
                if "constant" in given:
                    made = np.full(len(texts), given["constant"])
                else:
                    made = model.scores(*featurise(texts, hasher))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, len(texts)), pa.array(made.astype(float))],
                    names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def quality_digest(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> DataFrame:
    """The contract's columns: doc_id, held_out, score, predicted."""
    scored = quality_scores(docs, train(docs, labels, limit=limit))
    return scored.select("doc_id", held_out(F.col("doc_id"), *HELD_OUT).alias("held_out"), "score",
                         F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
