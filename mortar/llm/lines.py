"""Line dedup (native): drop lines that many documents share.

Lines are exploded, normalised and hashed; distinct documents are counted
per hash; a line whose key is found in at least ``min_docs`` documents stays
only in the largest doc_id that holds it; texts are reassembled by position.

Defined cases: a null or empty text is one empty line; a key shorter than
``min_chars`` code points is never dropped; a document is a doc_id, so
repeated rows count once and each loses (or keeps) the same lines; a row
with a null doc_id counts for nothing and is never the holder that keeps a
line; an empty table gives an empty result; other input columns pass
through, and a computed column replaces an input column of its name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .text import BLANKS, ascii_lower, cut, fingerprint, lookup, with_columns

MIN_CHARS = 40
MIN_DOCS = 5


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.btrim(ascii_lower(line), F.lit(BLANKS))


def repeated_lines(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(h, n_docs, keeper) of the line hashes found in at least ``min_docs`` documents."""
    return (
        lines.groupBy("h")
        .agg(F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("keeper"))
        .where(F.col("n_docs") >= min_docs)
    )


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with ``text`` rid of shared lines, plus ``n_lines`` and ``n_dropped``."""
    mark = F.xxhash64("text")  # tells apart rows that repeat a doc_id with another text
    lines = (
        docs.select("doc_id", mark.alias("mark"), F.posexplode(text_lines(F.col("text"))).alias("pos", "line"))
        .select("doc_id", "mark", "pos", line_key(F.col("line")).alias("key"))
        .where(F.length("key") >= min_chars)
        .select("doc_id", "mark", "pos", fingerprint(F.col("key")).alias("h"))
    )
    shared = cut(repeated_lines(lines, min_docs))
    held = lookup(lines, shared, "h", "n_docs", [F.col("doc_id"), F.col("pos")])
    drops = (
        held.where(F.col("n_docs").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"))
        .agg(F.collect_set("pos").alias("_drop"))
    )
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("_doc"), mark.alias("_of"))
    joined = rows.join(
        drops, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_of") == F.col("_mark")), "left"
    ).withColumn("_lines", text_lines(F.col("_row")["text"]))
    every = F.sequence(F.lit(0), F.size("_lines") - 1)
    kept = F.transform(F.array_except(every, F.col("_drop")), lambda i: F.get(F.col("_lines"), i))
    dropped = F.col("_drop").isNotNull()
    return with_columns("_row", docs.columns, joined, {
        "text": F.when(dropped, F.array_join(kept, "\n")).otherwise(F.col("_row")["text"]),
        "n_lines": F.size("_lines").cast("long"),
        "n_dropped": F.when(dropped, F.size("_drop")).otherwise(F.lit(0)).cast("long"),
    })


def line_digest(docs: DataFrame, **params) -> DataFrame:
    """The contract's columns: doc_id, n_lines, n_dropped, kept_sha256."""
    done = dedup_lines(docs.select("doc_id", "text"), **params)
    return done.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
