"""Labelled rows: the held-out rule and bounded training samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .text import cut, fingerprint


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """crc32 of the id as text falls on ``remainder``; a null id is never held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(modulus)) == remainder, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, out: tuple[int, int], limit: int) -> DataFrame:
    """(text, label) of at most ``limit`` labelled documents that are not held out, written once.

    The sample is the documents with the smallest id hashes, so it does not
    depend on row order; a document labelled twice counts with its larger label,
    one whose id the table repeats with the text of the least digest, so
    ``limit`` bounds the rows however often an id occurs.
    """
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), *out))
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    )
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id")
    one = rows.groupBy("doc_id", "label").agg(F.min(F.struct(fingerprint(F.col("text")), "text")).alias("least"))
    return cut(one.select(F.col("least.text").alias("text"), "label"))
