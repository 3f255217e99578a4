"""Spelling variant grouping by asymmetric q-chunks.

Two words are near if one inserted, deleted or replaced code point turns one
into the other.  The longer word (either, if alike in length) is cut into
two disjoint chunks, its halves: one edit spares a half, and the other word
holds that half as a positional gram, at the same place or, behind the edit,
one place off.  A half alone would bring all words of a common ending
together, so the method is applied once more to the other half, where the
edit must be: it is cut into two chunks, of which one edit spares one.  A
posting is thus a spared half with a spared chunk of the rest; the other
word posts its grams at the places that chunks can have in it, for its own
length and for the length above.  Postings are joined and pairs verified.

An edit lies in one quarter of the longer word, so a pair meets under that
quarter's posting only; a deletion inside a run of equal letters that
crosses quarters counts for the first of them.  Pairs are therefore unique
without a further shuffle.

A posting's group holds words that differ in one quarter only, so it is
bounded by the alphabet, not by the corpus, and never holds a word twice:
words are counted, with map-side sums, before anything else.

Defined cases: a null text has no words, a null doc_id is the empty text in
the hash; empty tables give empty results; repeated documents count each
time; extra columns are not read; words of any length take part whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .text import ascii_lower, cut

# --- fixed values: the contract's letters and bounds -------------------------
LETTERS = "A-Za-zÀ-ÿ"
MIN_CHARS = 7
MIN_COUNT = 2
SLIP = 31
RATIO = 10
# --- end of fixed values ------------------------------------------------------


def word_counts(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
                slip: int | None = SLIP) -> DataFrame:
    """(word, n): words of at least ``min_chars`` letters and their occurrences.

    ``slip``: where the checksum of doc_id and word is divisible by it, the
    word loses the letter the checksum points at (None: words as they are).
    """
    # shorter runs cannot become words: the pattern leaves them out
    runs = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"[{LETTERS}]{{{min_chars},}}+"), F.lit(0))
    words = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                        F.explode(runs).alias("run")).select("id", ascii_lower(F.col("run")).alias("word"))
    if slip is not None:
        at = F.pmod(F.col("h"), F.length("word")).cast("int")
        short = F.concat(F.substring("word", F.lit(1), at), F.substring(F.col("word"), at + 2, F.length("word")))
        words = words.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "word"))).select(
            F.when(F.col("h") % slip == 0, short).otherwise(F.col("word")).alias("word"))
        words = words.where(F.length("word") >= min_chars)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _places(length: Column) -> list[Column]:
    """Borders of the four quarters of a word of that length."""
    half = F.ceil(length / 2).cast("int")
    return [F.lit(0), F.ceil(half / 2).cast("int"), half,
            half + F.ceil((length - half) / 2).cast("int"), length]


def _postings(word: Column, own: Column, length: Column) -> Column:
    """Array of (key, k): quarter ``k`` of a word of ``length`` is left out, the rest must be alike.

    ``own`` is this word's length: what stands behind quarter ``k`` starts
    ``length - own`` places earlier in it.
    """
    at = _places(length)
    made = []
    for k in range(4):
        head = F.substring(word, F.lit(1), at[k])
        tail = F.substring(word, at[k + 1] + 1 + own - length, length)
        made.append(F.struct(F.xxhash64(length, F.lit(k), head, tail).alias("key"), F.lit(k).alias("k")))
    return F.array(*made)


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): every pair of near words once; ``words`` is (word, n), each word once."""
    size = F.length("word")
    chunks = words.select("word", "n", F.inline(_postings(F.col("word"), size, size)))
    grams = words.select("word", "n", F.inline(_postings(F.col("word"), size, size + 1)))
    left = chunks.select("key", F.col("k"), F.col("word").alias("a"), F.col("n").alias("a_n"))
    right = chunks.union(grams).select(F.col("key").alias("_key"), F.col("k").alias("_k"),
                                       F.col("word").alias("b"), F.col("n").alias("b_n"))
    longer = F.length("a") > F.length("b")
    met = left.join(right, (F.col("key") == F.col("_key")) & (F.col("k") == F.col("_k"))
                    & (longer | ((F.length("a") == F.length("b")) & (F.col("a") < F.col("b")))))
    start = F.element_at(F.array(*_places(F.length("a"))), F.col("k") + 1)
    # the same deletion one quarter earlier: that posting finds the pair
    earlier = longer & (F.col("k") > 0) & (
        F.substring(F.col("a"), start, F.lit(1)) == F.substring(F.col("a"), start + 1, F.lit(1))) & (
        F.concat(F.substring(F.col("a"), F.lit(1), start),
                 F.substring(F.col("a"), start + 2, F.length("a"))) == F.col("b"))
    return met.where((F.levenshtein("a", "b", 1) == 1) & ~earlier).select("a", "a_n", "b", "b_n")


def _roots(links: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last, doubling the step each round.

    A form has at least RATIO times the word's occurrences, so chains are at
    most as long as the logarithm of the largest count.
    """
    now = cut(links.select("word", F.col("form").alias("root")))
    while True:
        step = now.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        new = cut(now.join(step, F.col("root") == F.col("_w"), "left").select(
            "word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved")))
        if new.where("moved").limit(1).count() == 0:
            return now
        now = new.drop("moved")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a (word, n) table that holds each word once."""
    words = cut(words)
    pairs = near_pairs(words)
    both = F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
                   F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))
    best = pairs.select(F.inline(both)).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("top"))
    known = words.join(best, "word", "left")
    strong = -F.col("top.m") >= ratio * F.col("n")
    known = cut(known.select(
        "word", F.when(strong, F.col("top.near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, -F.col("top.m")).cast("long").alias("form_n")))
    roots = _roots(known.where(F.col("form").isNotNull()))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variant_digest(docs: DataFrame, **params) -> DataFrame:
    """The contract's rows over the words of ``docs``."""
    return variants(word_counts(docs.select("doc_id", "text"), **params))
