"""Benchmark decontamination (native): a distributed positional inverted index.

Postings (term, document, position) of the training tokens are stored, doc
by doc, for the terms that drive the search: the rarest terms (by corpus
count) of every benchmark window.  A window's lists are shifted by the
term's offset and intersected from the rarest on, within ``slop`` words;
what is left is a proximity match, and those whose words equal the window's
at the exact place are phrase matches.

The index is split by document, so no term's list ever meets in one task.

Defined cases: a null text has no words; an item of fewer words than the
window is one window, an item without words none; repeated rows each get
the same result; repeated items count once per item_id; an empty benchmark
leaves every document clean.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, Window

from ..session import scratch_path
from .text import MAX_BROADCAST_ROWS, broadcast_if_small, cut, with_columns, word_array

WINDOW = 10
RAREST = 3
SLOP = 3


def item_windows(bench: DataFrame, width: int = WINDOW) -> DataFrame:
    """(wid, words, item_id): every window of every item."""
    words = bench.select("item_id", word_array(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - width, F.lit(0)))
    each = words.select("item_id", "w", F.explode(starts).alias("s"))
    return (
        each.select("item_id", F.slice("w", F.col("s") + 1, F.least(F.size("w"), F.lit(width))).alias("words"))
        .select(F.sha2(F.array_join("words", " "), 256).alias("wid"), "words", "item_id")
        .distinct()
    )


def document_words(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("mark"), word_array(F.col("text")).alias("words"))


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, mark, term, pos) of every occurrence of the given terms.

    Explode, probe and filter run in one generated loop over the document's
    word array; nothing is shuffled while the term table may be broadcast.
    """
    tokens = document_words(docs).select("doc_id", "mark", F.posexplode("words").alias("pos", "token"))
    terms = broadcast_if_small(terms.select("term"))
    return tokens.join(terms, F.col("token") == F.col("term")).select("doc_id", "mark", "term", "pos")


def term_counts(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(term, n): corpus count of every vocabulary term, 0 where the corpus lacks it."""
    seen = postings(docs, vocabulary).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return vocabulary.join(seen, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))


def rarest_terms(windows: DataFrame, counts: DataFrame, rarest: int = RAREST) -> DataFrame:
    """(wid, rank, term, offset): the ``rarest`` positions of a window, by corpus count."""
    each = windows.select("wid", F.posexplode("words").alias("offset", "term")).join(counts, "term")
    w = Window.partitionBy("wid").orderBy("n", "offset")  # a window holds ten words at most
    return each.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= rarest).select(
        "wid", "rank", "term", "offset")


def intersect(index: DataFrame, plan: DataFrame, rarest: int = RAREST, slop: int = SLOP) -> DataFrame:
    """(doc_id, mark, wid, start): places where a window's rarest terms stand within ``slop``.

    Starts from the rarest term's list; every further list must hold the
    term at the offset-adjusted place, give or take ``slop`` words.  Places
    are cut into cells of ``slop + 1`` words, so that the step is an
    equi-join on (document, term, cell).
    """
    first = broadcast_if_small(plan.where(F.col("rank") == 1).select("wid", "term", "offset"))
    at = index.join(first, "term").select("doc_id", "mark", "wid", (F.col("pos") - F.col("offset")).alias("start"))
    cell = slop + 1
    for rank in range(2, rarest + 1):
        step = plan.where(F.col("rank") == rank).select("wid", F.col("term").alias("_t"), F.col("offset").alias("_o"))
        wanted = at.join(broadcast_if_small(step), "wid", "left").withColumn("_e", F.col("start") + F.col("_o"))
        around = F.array(*[F.floor(F.col("_e") / cell) + d for d in (-1, 0, 1)])
        probes = wanted.where(F.col("_t").isNotNull()).withColumn("_c", F.explode(around))
        asked = broadcast_if_small(step.select(F.col("_t").alias("_a")).distinct())
        lists = index.join(asked, F.col("term") == F.col("_a"), "left_semi").select(
            F.col("doc_id").alias("_d"), F.col("mark").alias("_m"), F.col("term").alias("_lt"),
            F.col("pos").alias("_p"), F.floor(F.col("pos") / cell).alias("_lc"))
        found = probes.join(
            lists,
            F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("mark") == F.col("_m")) & (F.col("_t") == F.col("_lt"))
            & (F.col("_c") == F.col("_lc")) & (F.abs(F.col("_p") - F.col("_e")) <= slop),
            "left_semi",
        ).select("doc_id", "mark", "wid", "start").distinct()
        short = wanted.where(F.col("_t").isNull()).select("doc_id", "mark", "wid", "start")
        at = found.unionByName(short)
    return at


def find_matches(docs: DataFrame, bench: DataFrame, width: int = WINDOW, rarest: int = RAREST,
                 slop: int = SLOP) -> DataFrame:
    """``docs`` plus n_words, n_hit, ``exact`` (wid, start) and ``near`` (wid, start) matches."""
    spark = docs.sparkSession
    items = item_windows(bench, width)
    windows = cut(items.select("wid", "words").distinct())
    vocabulary = cut(windows.select(F.explode("words").alias("term")).distinct())
    plan = cut(rarest_terms(windows, term_counts(docs, vocabulary), rarest))
    path = scratch_path(spark, "postings")
    postings(docs, plan.select("term").distinct()).write.parquet(path)
    places = intersect(spark.read.parquet(path), plan, rarest, slop)
    # only windows that have a place are carried to the documents
    listed = places.join(broadcast_if_small(windows, MAX_BROADCAST_ROWS // 4), "wid")
    per_doc = listed.groupBy(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).agg(
        F.collect_set(F.struct("start", "wid", "words")).alias("_found"))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("_doc"),
                       F.xxhash64("text").alias("_of"))
    joined = rows.join(per_doc, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_of") == F.col("_mark")), "left")
    joined = joined.withColumn("_words", word_array(F.col("_row")["text"]))

    def stands(m):
        return F.when(m["start"] >= 0, F.slice(F.col("_words"), m["start"] + 1, F.size(m["words"])) == m["words"]
                      ).otherwise(F.lit(False))

    joined = joined.withColumn("_exact", F.when(F.col("_found").isNotNull(), F.filter("_found", stands)))
    spans = F.flatten(F.transform("_exact", lambda m: F.sequence(m["start"], m["start"] + F.size(m["words"]) - 1)))
    empty = F.lit(None).cast("array<struct<wid:string,start:int>>")

    def places_of(found):
        return F.transform(found, lambda m: F.struct(m["wid"].alias("wid"), m["start"].cast("int").alias("start")))

    near = F.array_except(places_of(F.col("_found")), places_of(F.col("_exact")))
    has = F.col("_found").isNotNull()
    return with_columns("_row", docs.columns, joined, {
        "n_words": F.size("_words").cast("long"),
        "n_hit": F.when(has, F.size(F.array_distinct(spans))).otherwise(F.lit(0)).cast("long"),
        "exact": F.when(has, places_of(F.col("_exact"))).otherwise(empty),
        "near": F.when(has, near).otherwise(empty),
    })


def decontaminate(docs: DataFrame, bench: DataFrame, **params) -> DataFrame:
    """The documents without any phrase match; clean ones pass unchanged."""
    found = find_matches(docs, bench, **params)
    own = [c for c in docs.columns if c.lower() not in ("n_words", "n_hit", "exact", "near")]
    return found.where(F.col("n_hit") == 0).select(*own)


def match_digest(docs: DataFrame, bench: DataFrame, **params) -> DataFrame:
    """The contract's columns, plus ``n_near`` (items matched by proximity only)."""
    found = cut(find_matches(docs.select("doc_id", "text"), bench, **params).select(
        "doc_id", F.xxhash64("text").alias("mark"), "n_words", "n_hit", "exact", "near"))
    width = params.get("width", WINDOW)
    items = cut(item_windows(bench, width).select("wid", "item_id"))
    hits = found.select("doc_id", "mark", F.explode(F.concat(
        F.transform("exact", lambda m: F.struct(m["wid"].alias("wid"), F.lit(True).alias("exact"))),
        F.transform("near", lambda m: F.struct(m["wid"].alias("wid"), F.lit(False).alias("exact"))))).alias("m"))
    named = (
        hits.select("doc_id", "mark", "m.wid", "m.exact").distinct().join(broadcast_if_small(items), "wid")
        .groupBy(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "item_id")
        .agg(F.max("exact").alias("exact"))
        .groupBy("_id", "_mark")
        .agg(F.collect_list(F.when(F.col("exact"), F.col("item_id").cast("string"))).alias("_items"),
             F.count_if(~F.col("exact")).alias("_near"))
    )
    out = found.join(named, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")), "left")
    items_of = F.coalesce(F.sort_array("_items"), F.array().cast("array<string>"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size(items_of).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_of, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.coalesce("_near", F.lit(0)).cast("long").alias("n_near"),
    )
