"""Near duplicates by an n-gram Jaccard self-join with token-combination prefixes.

Documents become sets of 5-word shingle fingerprints.  Equal sets collapse to
one class.  Tokens are put in one global order, rare ones first, the
frequent ones (corpus counts) last.  By the prefix principle two sets of
similarity t share at least k tokens of their prefixes when these are
extended by k - 1 tokens.  With k = 2 the extended prefix of a short set is
indexed by its single rare tokens and by all pairs of its frequent tokens;
long sets, whose prefix hardly ever reaches the frequent tokens and would
hold too many pairs, are indexed by the single tokens of the plain prefix.
Sets near the border between the two are in both indexes, so every similar
pair meets under some key.

A pair is first tested on bitmaps of the two sets, which bound their overlap
from above, and, unless that rules it out, compared exactly on the whole sets.

Only components are asked for, so a key's documents are not expanded into
all pairs.  A short list is compared pair by pair.  The documents of long lists
are first tested alone: a token that no other document of any long list holds
cannot be shared, and so many of them leave room only for partners up to a
certain size, or for none (``reach``); so does the number of tokens before the
key in the global order, since two sets that first meet there share none of
them.  What can still link is compared with one document of the list, the one
with the least of such tokens first, in a few
rounds where many pairs would be left; then those documents of a list that are
in different components and within each other's reach are compared, all of them.
A round takes up only what the one before has left of lists that have many pairs.

Skew: equal sets are one class whatever their number; keys of tokens with
very high corpus counts are dealt over several sub-lists for the first
comparisons, and the sub-lists of a key meet in the later ones, which go by
the whole key; copies look up their class by ``text.lookup``.

Defined cases: null, empty and blank texts have an empty set and stand
alone; fewer than five words make one shingle of the whole sequence; repeated
rows are copies; a null doc_id never names a component unless all have none.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from ..session import remove_path, scratch_path
from .components import components
from .text import broadcast_if_small, cut, fingerprint, lookup, small_batches

# Workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORDS = 5
PERCENT = 80
# A set of at most PAIRED tokens is indexed by pairs of frequent tokens; one of
# more than PERCENT % of that by single tokens (both in between).
PAIRED = 80
# Frequent: this corpus count at least, and more where that would make more
# than FREQUENT_TOKENS of them (the size of the broadcast token table).
FREQUENT = 9
FREQUENT_TOKENS = 1_000_000
# Tokens whose hash is among a set's lowest (its prefix and LOW of the set
# besides) are all counted; others where LOCAL or more meet in a window.
LOW = 0.05
COUNT_WINDOW = 2_000_000
LOCAL = 3
# Lists of a key: compared pair by pair up to SHORT; sub-lists hold about LIST;
# a longer list is compared with one of its members, chosen in HUBS ways, up to
# ROUNDS times, while it would leave over PAIRS pairs a document.
SHORT = 8
LIST = 10_000
HUBS = 16
ROUNDS = 3
PAIRS = 8
CHUNK_BYTES = 1 << 20

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (multiply and xor-shift rounds)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Shingler:
    """Sets of 64-bit shingle fingerprints, many texts at a time."""

    def __init__(self, words: int = WORDS):
        self.words = words
        seed = np.arange(1, 300, dtype=_U) * _U(0x9E3779B97F4A7C15)
        self.letters = _mix(seed[:256])
        self.factors = _mix(seed[256:256 + words + 1]) | _U(1)
        self.blank = np.zeros(256, bool)
        self.blank[[32, 9, 10, 11, 12, 13]] = True
        self.base = _U(0x2545F4914F6CDD1D)
        self.back = _U(pow(0x2545F4914F6CDD1D, -1, 1 << 64))
        self.power = self.inverse = np.ones(1, _U)

    def _powers(self, n: int) -> None:
        if len(self.power) < n:
            n = max(n + n // 8, CHUNK_BYTES + CHUNK_BYTES // 8)
            for name, factor in (("power", self.base), ("inverse", self.back)):
                steps = np.full(n, factor)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=_U))

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        """Sorted distinct fingerprints of each text."""
        lengths = np.array([len(t) + 1 for t in texts])
        data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        self._powers(len(data) + 1)
        word = ~self.blank[data]
        edge = np.diff(word.astype(np.int8), prepend=0, append=0)
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        # prefix sums of letter values times powers: a word's sum, shifted back to its start
        sums = np.zeros(len(data) + 1, _U)
        sums[1:] = self.letters[data]
        sums[1:] *= self.power[:len(data)]
        np.cumsum(sums, out=sums)
        hashes = _mix((sums[end] - sums[begin]) * self.inverse[begin] + (end - begin).astype(_U))
        stops = np.searchsorted(begin, np.cumsum(lengths))
        k, total = self.words, len(hashes)
        rolled = np.zeros(max(total - k + 1, 0), _U)
        for i in range(k):
            rolled += hashes[i:i + len(rolled)] * self.factors[i]
        rolled = _mix(rolled)
        out, first = [], 0
        for stop in stops:
            n = int(stop) - first
            if n >= k:
                one = np.sort(rolled[first:stop - k + 1])
                if len(one) > 1:
                    one = one[np.concatenate(([True], one[1:] != one[:-1]))]
            elif n:
                one = (hashes[first:stop] * self.factors[:n]).sum(dtype=_U, keepdims=True)
                one = _mix(one + self.factors[k:k + 1] * _U(n))
            else:
                one = np.zeros(0, _U)
            out.append(one)
            first = int(stop)
        return out


def _chunks(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[int, list[bytes]]]:
    """(first row, lower-cased texts) in pieces of about CHUNK_BYTES."""
    texts, first, size = [], 0, 0
    for row, t in enumerate(batch.column(column).cast(pa.binary())):
        text = (t.as_py() or b"").lower()  # of bytes: A-Z only
        texts.append(text)
        size += len(text)
        if size >= CHUNK_BYTES:
            yield first, texts
            texts, first, size = [], row + 1, 0
    if texts:
        yield first, texts


def bitmap(tokens: np.ndarray) -> bytes:
    """A bit per token at (token mod size), the size a power of two of 2 to 4 bits a token."""
    size = max(64, 1 << int(2 * len(tokens) - 1).bit_length())
    bits = np.zeros(size, bool)
    bits[(tokens % _U(size)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def at_most(x: bytes, nx: int, y: bytes, ny: int) -> int:
    """An upper bound of two sets' overlap from their bitmaps and sizes.

    A bit that only x has stands for a token (or more) that y lacks.
    """
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    if len(a) > len(b):
        a = np.bitwise_or.reduce(a.reshape(-1, len(b)))
    elif len(b) > len(a):
        b = np.bitwise_or.reduce(b.reshape(-1, len(a)))
    return min(nx - int(np.bitwise_count(a & ~b).sum()), ny - int(np.bitwise_count(b & ~a).sum()))


def _needed(n: np.ndarray | int, percent: int):
    """Least overlap that a set of n tokens can have with a similar one."""
    return -(-n * percent // 100)


def frequent_tokens(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(token, n): corpus counts of the fingerprints that decide the prefixes.

    Rare tokens are ordered by their hash, so a prefix holds a set's lowest
    ones: these are counted in full.  Any other token is counted in the
    windows of the corpus where it recurs.  Only the token order and the
    choice of keys depend on the counts, never the result.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, low, high, size = Shingler(words), [], [], 0

        def flush():
            tokens, n = np.unique(np.concatenate(low), return_counts=True)
            more, m = np.unique(np.concatenate(high), return_counts=True)
            often = m >= LOCAL
            return pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([tokens, more[often]]).view(np.int64)),
                pa.array(np.concatenate([n, m[often]]).astype(np.int64))], names=["token", "n"])

        for batch in batches:
            for _, texts in _chunks(batch):
                for s in shingler.sets(texts):
                    if len(s) > 1:
                        cut_at = len(s) - int(_needed(len(s), percent)) + 2 + int(LOW * len(s))
                        low.append(s[:cut_at])
                        high.append(s[cut_at:])
                        size += len(s)
                if size >= COUNT_WINDOW:
                    yield flush()
                    low, high, size = [], [], 0
        if low:
            yield flush()

    return docs.select("text").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def _frequent_table(docs: DataFrame, words: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted frequent tokens and their counts: at most FREQUENT_TOKENS, by the bound on n."""
    counted = cut(frequent_tokens(docs, words, percent).where(F.col("n") >= FREQUENT))
    total = counted.agg(F.sum("n")).first()[0] or 0
    least = max(FREQUENT, -(-total // FREQUENT_TOKENS))
    table = counted.where(F.col("n") >= least).toArrow()
    tokens = table.column("token").to_numpy().view(_U)
    order = np.argsort(tokens)
    return tokens[order], table.column("n").to_numpy()[order]


def prefix_keys(tokens: np.ndarray, counts: np.ndarray, salt: np.uint64,
                percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index keys of one set, its sub-list (from 1; 0: undivided) of each, and the reach of each.

    ``counts`` are corpus counts of its tokens, 0 for rare ones.  Two sets that
    first meet at a key share none of the i tokens before it (a pair key: but
    its first one), which bounds the other's size as in ``reach``.  A pair of
    sets too large for a key's reach either meets before it or is not similar.
    """
    n = len(tokens)
    if n < 2:  # a one-token set is similar to its equals only
        return np.zeros(0, _U), np.zeros(0, np.int32), np.zeros(0, np.int64)
    plain = n - int(_needed(n, percent)) + 1
    order = np.lexsort((tokens, counts))[:plain + 1]
    made, parts, far = [], [], []

    def add(keys, count, before):
        lists = (count // LIST + 1).astype(_U)
        made.append(keys)
        parts.append(np.where(lists > 1, _mix(keys ^ salt) % lists + _U(1), _U(0)).astype(np.int32))
        far.append((n - before) * 100 // percent - before)

    if n > PAIRED * percent // 100:
        single = order[:plain]
        add(_mix(tokens[single] + _U(1)), counts[single], np.arange(len(single)))
    if n <= PAIRED:
        rare = order[counts[order] == 0]
        add(_mix(tokens[rare] + _U(2)), counts[rare], np.arange(len(rare)))
        often = order[counts[order] > 0]
        if len(often) > 1:
            a, b = np.triu_indices(len(often), 1)
            x, y = tokens[often[a]], tokens[often[b]]
            pair = _mix(_mix(np.minimum(x, y) + _U(3)) + np.maximum(x, y))
            add(pair, np.minimum(counts[often[a]], counts[often[b]]), len(rare) + b - 1)
    return np.concatenate(made), np.concatenate(parts), np.concatenate(far)


def _index_rows(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(row, doc_id, mark, tag, n, sig, bits, keys, parts, far): a number of the row, 128-bit and 64-bit
    hash of the text, set size, 128-bit digest and bitmap of the set, index keys, their sub-lists and reach."""
    table = docs.sparkSession.sparkContext.broadcast(_frequent_table(docs, words, percent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, (often, often_n) = Shingler(words), table.value
        for batch in batches:
            ids, marks, tags = batch.column("doc_id"), batch.column("mark"), batch.column("tag")
            for first, texts in _chunks(batch):
                sets = shingler.sets(texts)
                joined = np.concatenate(sets)
                counts = np.zeros(len(joined), np.int64)
                if len(often):
                    at = np.minimum(np.searchsorted(often, joined), len(often) - 1)
                    counts = np.where(often[at] == joined, often_n[at], 0)
                sigs, keys, parts, fars, bits, begin = [], [], [], [], [], 0
                for s in sets:
                    sig = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                    sigs.append(sig)
                    bits.append(bitmap(s))
                    key, part, far = prefix_keys(s, counts[begin:begin + len(s)], np.frombuffer(sig, _U)[0], percent)
                    keys.append(key)
                    parts.append(part)
                    fars.append(far)
                    begin += len(s)
                offsets = np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(first, len(texts)), marks.slice(first, len(texts)), tags.slice(first, len(texts)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(sigs, pa.binary()), pa.array(bits, pa.binary()),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(keys).view(np.int64))),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(parts))),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(fars)))],
                    names=["doc_id", "mark", "tag", "n", "sig", "bits", "keys", "parts", "far"])

    return docs.select(
        "doc_id", "text", fingerprint(F.col("text")).alias("mark"), F.xxhash64("text").alias("tag")).mapInArrow(
        run, "doc_id long, mark string, tag long, n long, sig binary, bits binary, keys array<long>, parts array<int>, far array<long>"
    ).withColumn("row", F.monotonically_increasing_id())


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings sorted by (key, part) -> comparisons (key null) and the postings of long or divided lists (b null)."""
    def emit(key, a, b, far):
        return pa.RecordBatch.from_arrays(
            [pa.array(key, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(far, pa.int64())],
            names=["key", "a", "b", "far"])

    def pairs(node, n, far, i, j):
        fit = (node[i] != node[j]) & (n[i] <= far[j]) & (n[j] <= far[i])
        i, j = i[fit], j[fit]
        a, b = np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
        none = pa.nulls(len(a), pa.int64())
        return emit(none, a, b, none)

    def starts(key, part):
        return np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (part[1:] != part[:-1]))))

    def work(key, part, node, n, far):
        begin = starts(key, part)
        size = np.diff(np.append(begin, len(key)))
        own = np.repeat(size, size)
        short = np.flatnonzero((own > 1) & (own <= SHORT))
        left, right = [], []
        for d in range(1, SHORT):
            i = short[short + d < len(key)]
            i = i[(key[i] == key[i + d]) & (part[i] == part[i + d])]
            left.append(i)
            right.append(i + d)
        yield pairs(node, n, far, np.concatenate(left), np.concatenate(right))
        later = np.flatnonzero((own <= SHORT) & (part > 0))  # to meet the key's other sub-lists
        yield emit(key[later], node[later], pa.nulls(len(later), pa.int64()), far[later])
        long = np.flatnonzero(own > SHORT)
        yield emit(key[long], node[long], pa.nulls(len(long), pa.int64()), far[long])

    held = None
    for batch in batches:
        cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "part", "node", "n", "far")]
        held = cols if held is None else [np.concatenate(p) for p in zip(held, cols)]
        whole = int(starts(*held[:2])[-1]) if len(held[0]) else 0  # the last list may go on
        if whole:
            yield from work(*[c[:whole] for c in held])
            held = [c[whole:] for c in held]
    if held is not None and len(held[0]):
        yield from work(*held)


def _possible(pairs: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` that their bitmaps do not rule out; ``bitmaps`` is (node, n, bits)."""
    left, right = (bitmaps.select(F.col("node").alias(k), F.col("n").alias("n" + k), F.col("bits").alias("b" + k))
                   for k in ("a", "b"))

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fit = []
            for x, y, nx, ny in zip(*[batch.column(c).to_pylist() for c in ("ba", "bb", "na", "nb")]):
                most = at_most(x, nx, y, ny)
                fit.append(100 * most >= percent * (nx + ny - most))
            yield batch.select(["a", "b"]).filter(pa.array(fit, pa.bool_()))

    return pairs.select("a", "b").join(left, "a").join(right, "b").select(
        "a", "b", "na", "nb", "ba", "bb").mapInArrow(test, "a long, b long")


def _sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """(node, set: array of tokens) of the given class nodes, from the texts of their first documents.

    Texts are found by doc_id and hash, so many null or repeated doc_ids do not meet each other's classes.
    """
    wanted = classes.join(nodes, "node").select("node", "rep", "tag", "sig")
    texts = docs.select("doc_id", "text").join(
        broadcast_if_small(wanted, 1_000_000),
        F.col("doc_id").eqNullSafe(F.col("rep")) & (F.xxhash64("text") == F.col("tag"))).select("node", "sig", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            for first, some in _chunks(batch):
                made = shingler.sets(some)
                # another text of the same hash is not the class's own
                own = [hashlib.blake2b(m.tobytes(), digest_size=16).digest() == sig.as_py()
                       for m, sig in zip(made, batch.column("sig").slice(first, len(some)))]
                offsets = np.concatenate(([0], np.cumsum([len(m) for m in made]))).astype(np.int32)
                rows = pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(first, len(some)),
                     pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(made).view(np.int64)))], names=["node", "set"])
                yield rows.filter(pa.array(own))

    return texts.mapInArrow(sets, "node long, set array<long>")


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The (u, v) of ``pairs`` (a, b: class nodes) whose whole sets are similar."""
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    made = _sets(docs, classes, ends, words)
    left = made.select(F.col("node").alias("a"), F.col("set").alias("sa"))
    right = made.select(F.col("node").alias("b"), F.col("set").alias("sb"))
    # in the JVM: thousands of whole sets a batch are too much for the Python workers beside it
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select(
        "a", "b", F.size("sa").cast("long").alias("na"), F.size("sb").cast("long").alias("nb"),
        F.size(F.array_intersect("sa", "sb")).cast("long").alias("same"))
    return both.where(100 * F.col("same") >= percent * (F.col("na") + F.col("nb") - F.col("same"))).select(
        F.col("a").alias("u"), F.col("b").alias("v")).distinct()


def reach(docs: DataFrame, classes: DataFrame, nodes: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, n, most): the largest size that a set similar to a node's can have, among the sets of ``nodes``.

    With p tokens that none of the others holds, the overlap is n - p at the
    most, and 100 * (n - p) >= percent * (n + m - (n - p)) bounds the other
    set's size m.  Nodes that not even the smallest similar set could meet are
    left out.
    """
    own = _sets(docs, classes, nodes, words).select(F.explode("set").alias("token"), "node").groupBy("token").agg(
        F.min("node").alias("node"), F.max("node").alias("last")).where(F.col("node") == F.col("last")).groupBy(
        "node").agg(F.count(F.lit(1)).alias("own"))
    own_n = F.coalesce("own", F.lit(0))
    most = F.floor((F.col("n") - own_n) * 100 / percent).cast("long") - own_n
    return classes.select("node", "n").join(nodes, "node").join(own, "node", "left").select(
        "node", "n", most.alias("most")).where(F.col("most") * 100 >= F.col("n") * percent)


def _still_apart(rows: DataFrame) -> DataFrame:
    """The (key, node, n, most, label) of each list that another one of the list, of another component, may be similar to,
    and the list's ``size`` so far.

    Two nodes may be similar if each one's size is in the other's reach.  Of
    two nodes that do not reach their own size one would have to be smaller
    than the other and larger, so one of a pair does ("strong").  Components
    only grow together: what is left out here need not be asked again.
    """
    strong = F.col("most") >= F.col("n")
    lists = cut(rows.groupBy("key").agg(
        F.min(F.when(strong, F.col("label"))).alias("low"), F.max(F.when(strong, F.col("label"))).alias("high"),
        F.min(F.when(strong, F.col("n"))).alias("least"), F.max(F.when(~strong, F.col("most"))).alias("weak"),
        F.count(F.lit(1)).alias("size"), F.min("label").alias("one"), F.max("label").alias("other"),
    ).where((F.col("one") != F.col("other")) & F.col("least").isNotNull()).drop("one", "other"))
    apart = F.col("low") != F.col("high")
    found = lookup(rows, lists, "key", "size", [F.col("node")]).where(F.col("size").isNotNull()).where(
        F.when(strong, apart | (F.coalesce("weak", F.lit(-1)) >= F.col("n"))).otherwise(
            (F.col("most") >= F.col("least")) & (apart | (F.col("label") != F.col("low")))))
    return found.select("key", "node", "n", "most", "label", "size")


def _pairs_left(rows: DataFrame) -> tuple[int, float]:
    """Rows of the lists, and their pairs of different components (a pair counts in each of its lists)."""
    size, pairs = rows.groupBy("key", "label").agg(F.count(F.lit(1)).alias("own")).groupBy("key").agg(
        F.sum("own").alias("size"), F.sum(F.col("own").cast("double") * F.col("own")).alias("within")).agg(
        F.sum("size"), F.sum((F.col("size").cast("double") * F.col("size") - F.col("within")) / 2)).first()
    return size or 0, pairs or 0.0


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.drop("label").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _with_hubs(rest: DataFrame, step: int) -> DataFrame:
    """(a, b): the documents of each list with one of them, if in another component.

    First the one with the least tokens of its own, then others by key and ``step``.
    """
    rows = rest.withColumn("way", F.pmod(F.xxhash64("key"), F.lit(HUBS)))
    by_hash = F.xxhash64("node", "way", F.lit(step))
    order = F.struct((F.col("most") < F.col("n")).alias("weak"), by_hash.alias("h")) if step else F.struct(
        (-F.col("most") / F.col("n")).alias("weak"), by_hash.alias("h"))
    hubs = cut(rows.groupBy("key").agg(
        F.min_by(F.struct("node", "n", "most", "label"), order).alias("hub"), F.count(F.lit(1)).alias("size")))
    return lookup(rows, hubs, "key", "size", [F.col("node")]).where(
        (F.col("label") != F.col("hub.label")) & (F.col("n") <= F.col("hub.most")) & (F.col("hub.n") <= F.col("most"))
    ).select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")).distinct()


def link_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, mark, n_shingles, component_id, label), one row per row of ``docs``.

    ``mark`` tells texts apart, ``label`` components; a single document without copies has none.
    """
    with small_batches(docs.sparkSession):
        return _linked(docs, words, percent)


def _linked(docs: DataFrame, words: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    index_path, list_path = scratch_path(spark, "shingle-index"), scratch_path(spark, "shingle-lists")
    _index_rows(docs, words, percent).write.parquet(index_path)
    index = spark.read.parquet(index_path)

    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "tag")).alias("first")
    grouped = index.where(F.col("n") > 0).groupBy("sig").agg(first, F.max("n").alias("n"), F.count(F.lit(1)).alias("copies"))
    classes = cut(grouped.select(
        F.monotonically_increasing_id().alias("node"), "sig", F.col("first.doc_id").alias("rep"),
        F.col("first.row").alias("row"), F.col("first.tag").alias("tag"), "n", "copies"))
    # the class's first row stands for all its copies
    one = index.select("row", "n", "keys", "parts", "far").join(classes.select("row", "node"), "row")
    bitmaps = cut(index.select("row", "n", "bits").join(classes.select("row", "node"), "row").select("node", "n", "bits"))
    postings = one.select(F.explode(F.arrays_zip("keys", "parts", "far")).alias("p"), "node", "n").select(
        F.col("p.keys").alias("key"), F.col("p.parts").alias("part"), "node", "n", F.col("p.far").alias("far"))
    (postings.repartition("key", "part").sortWithinPartitions("key", "part")
     .mapInArrow(_lists, "key long, a long, b long, far long")
     .write.parquet(list_path))
    lists = spark.read.parquet(list_path)

    # short lists
    tried = cut(lists.where(F.col("key").isNull()).select("a", "b").distinct())
    links = cut(_verified(docs, classes, cut(_possible(tried, bitmaps, percent)), words, percent))
    labels = components(links)
    # long lists: what is still in different components, whatever its sub-list
    posted = lists.where(F.col("key").isNotNull()).select(F.col("key").cast("string").alias("key"), F.col("a").alias("node"), "far")
    able = cut(reach(docs, classes, posted.select("node").distinct(), words, percent))
    rest = posted.join(able, "node").withColumn("most", F.least("most", "far")).drop("far")
    later = None  # lists of at most PAIRS pairs a document wait for the end
    for step in range(ROUNDS + 1):
        found = cut(_still_apart(_labelled(rest, labels)))
        left = later.unionByName(found) if step else found
        size, pairs = _pairs_left(left)
        if step == ROUNDS or not size or pairs <= PAIRS * size:
            break
        many = F.col("size") > 2 * PAIRS + 1
        later, rest = left.where(~many), found.where(many).drop("size")
        met = cut(_possible(_with_hubs(rest, step).join(tried, ["a", "b"], "left_anti"), bitmaps, percent))
        more = cut(_verified(docs, classes, met, words, percent))
        tried, links = tried.union(met), links.union(more)
        if not more.isEmpty():
            labels = components(links)
        elif step:
            break
    if size:
        rest = cut(_labelled(left, labels)) if step else left
        other = rest.select("key", F.col("node").alias("b"), F.col("n").alias("m"), F.col("most").alias("far"),
                            F.col("label").alias("with"))
        cross = rest.withColumnRenamed("node", "a").join(other, "key").where(
            (F.col("a") < F.col("b")) & (F.col("label") != F.col("with"))
            & (F.col("m") <= F.col("most")) & (F.col("n") <= F.col("far"))
        ).select("a", "b").distinct().join(tried, ["a", "b"], "left_anti")
        more = cut(_verified(docs, classes, cut(_possible(cross, bitmaps, percent)), words, percent))
        if not more.isEmpty():
            labels = components(links.union(more))

    names = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = names.groupBy("label").agg(F.min("rep").alias("component_id"), F.count(F.lit(1)).alias("parts"))
    # single documents without links are their own component and need no lookup
    grouped = cut(names.join(least, "label").where((F.col("parts") > 1) | (F.col("copies") > 1)).select(
        F.hex("sig").alias("sig"), "copies", "component_id", "label"))
    rows = cut(index.select("doc_id", "mark", "n", F.hex("sig").alias("sig")))
    for path in (index_path, list_path):  # read by nothing from here on
        remove_path(spark, path)
    found = lookup(rows, grouped, "sig", "copies", [F.col("doc_id")])
    return found.select("doc_id", "mark", F.col("n").alias("n_shingles"),
                        F.coalesce("component_id", "doc_id").alias("component_id"), "label")


def component_digest(docs: DataFrame, **params) -> DataFrame:
    """The contract's columns: doc_id, n_shingles, component_id."""
    return link_components(docs, **params).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame, **params) -> DataFrame:
    """``docs`` with one row of each component: one with the smallest doc_id, null last.

    Rows are told apart by doc_id and text, so another text of the same
    doc_id, or of another null one, is a document of its own.  Rows without
    words all stay; of rows that repeat a doc_id with its text one stays.
    """
    found = cut(link_components(docs, **params).where(F.col("label").isNotNull()).groupBy(
        F.col("label").cast("string").alias("label"), "doc_id", "mark").agg(F.count(F.lit(1)).alias("rows")))
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    least = cut(found.groupBy("label").agg(F.min(first).alias("least"), F.count(F.lit(1)).alias("size")))
    parted = cut(lookup(found, least, "label", "size", [F.col("doc_id"), F.col("mark")]).select(
        F.col("doc_id").alias("_id"), F.col("mark").alias("_text"), "rows", (first == F.col("least")).alias("stays")))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (fingerprint(F.col("text")) == F.col("_text"))
    gone = parted.where(~F.col("stays")).select("_id", "_text")
    kept = docs.join(broadcast_if_small(gone), same, "left_anti")
    again = parted.where(F.col("stays") & (F.col("rows") > 1)).select("_id", "_text")
    if again.isEmpty():
        return kept
    again = broadcast_if_small(again)
    once = kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(again, same, "left_anti").unionByName(once)
