"""Column helpers and join shapes shared by the text operators.

Everything here is DataFrame expressions; no Python runs on rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_path

# --- fixed values: the contracts' character classes -------------------------
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\x0b\x0c\r"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# --- end of fixed values ------------------------------------------------------

# A table may be broadcast while it has at most this many (narrow) rows.
MAX_BROADCAST_ROWS = 200_000
# Keys joined by broadcast because they are the most frequent ones.
HEAVY_KEYS = 1024
ARROW_BYTES = 2 << 20
_ARROW_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else (``lower`` would also touch accented letters)."""
    pure_ascii = F.octet_length(c) == F.length(c)
    return F.when(pure_ascii, F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def word_array(text: Column) -> Column:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text; null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD, -1), "")


def fingerprint(c: Column) -> Column:
    """128 bits of SHA-256 as hex: equal iff the strings are equal, for any corpus size."""
    return F.substring(F.sha2(c, 256), 1, 32)


def cut(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder: later steps read it instead of recomputing.

    Parquet rather than ``checkpoint()``: compressed, and read by column.
    """
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside send about ARROW_BYTES a batch to Python, or less where the session says so.

    Batches of 10,000 whole texts are built in buffers outside the heap, of several
    times their size; they decide an executor's peak, not the result.
    """
    before = spark.conf.get(_ARROW_CONF)
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before)
    if 0 < size <= ARROW_BYTES:
        yield
        return
    spark.conf.set(_ARROW_CONF, str(ARROW_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_ARROW_CONF, before)


def broadcast_if_small(df: DataFrame, rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting; beyond ``rows`` the join shuffles instead."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def lookup(rows: DataFrame, table: DataFrame, key: str, weight: str, spread: Sequence[Column],
           heavy_keys: int = HEAVY_KEYS) -> DataFrame:
    """Left join of many ``rows`` with ``table`` (one row per ``key``), safe under skew.

    ``weight`` is the number of rows per key.  The ``heavy_keys`` heaviest
    keys are broadcast: a fixed number of rows, and no other key can then
    hold more than 1/heavy_keys of all rows.  Rows that found their key that
    way are dealt by ``spread`` through the shuffle join of the rest, so one
    pass over ``rows`` does both.  Adds the table's columns (null: no match).
    """
    values = [c for c in table.columns if c != key]
    heavy = table.orderBy(F.desc(weight), key).limit(heavy_keys).select(
        F.col(key).alias("_hk"), F.struct(*values).alias("_hv"))
    rest = table.select(F.col(key).alias("_rk"), F.struct(*values).alias("_rv"))
    first = rows.join(F.broadcast(heavy), F.col(key) == F.col("_hk"), "left")
    dealt = first.withColumn(
        "_jk", F.when(F.col("_hk").isNull(), F.col(key)).otherwise(
            F.concat(F.lit("~"), F.xxhash64(*spread).cast("string"))))
    both = dealt.join(rest, F.col("_jk") == F.col("_rk"), "left")
    found = F.coalesce(F.col("_hv"), F.col("_rv"))
    return both.select(*rows.columns, *[found[v].alias(v) for v in values])


def with_columns(row: str, taken: Sequence[str], df: DataFrame, names: dict[str, Column]) -> DataFrame:
    """Unpack the struct column ``row`` of ``taken`` fields and set ``names`` on top.

    A computed column replaces an input column of the same name (in any case).
    """
    new = {n.lower() for n in names}
    kept = [F.col(row)[c].alias(c) for c in taken if c.lower() not in new]
    return df.select(*kept, *[c.alias(n) for n, c in names.items()])
