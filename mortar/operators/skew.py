"""Skew-safe building blocks for per-key ordered work.

A key (a loan, a user) that holds a large share of all rows must not land in
one task.  ``hot_keys`` finds such keys with a partial aggregate;
``global_positions`` numbers every row inside its key in time order while
spreading a hot key over many tasks; ``row_positions`` uses the plain
per-key window for ordinary keys and the split numbering for hot ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..session import checkpoint_root

# Key sets / block tables (a key and three longs a row) above this many rows
# are joined, not broadcast: about 100 MB with keys of up to 64 bytes.
MAX_BROADCAST_ROWS = 1_000_000


def hot_keys(df: DataFrame, key: str, threshold: int) -> DataFrame:
    """Keys with more than ``threshold`` rows; map-side combined, so skew-safe."""
    return df.groupBy(key).count().where(F.col("count") > threshold).select(key)


def split_by_key(rows: DataFrame, hot: DataFrame, key: str, n_hot: int) -> tuple[DataFrame, DataFrame]:
    """(rows of other keys, rows of the hot keys); a null key may be hot too."""
    named = hot.select(F.col(key).alias("_hot_key"))
    if n_hot <= MAX_BROADCAST_ROWS:
        named = F.broadcast(named)
    same = rows[key].eqNullSafe(F.col("_hot_key"))
    return rows.join(named, same, "left_anti"), rows.join(named, same, "left_semi")


def global_positions(rows: DataFrame, key: str, order: Sequence[str], n_hot: int,
                     name: str = "_pos") -> DataFrame:
    """0-based position of every row inside its key, without one task per key.

    Range partitioning on (key, order) spreads a hot key over many tasks;
    each task numbers its sorted rows, and a table of per-partition counts
    (at most partitions + hot keys rows) turns the local numbers into
    positions within the key.  ``order`` must be a total order per key.
    """
    keys = [key, *order]
    checkpoint_root(rows.sparkSession)  # the session's shared folder (set only where unset)
    # The numbered rows feed two consumers (the block table and the join), so
    # they are checkpointed to the shared checkpoint folder: both then see
    # the same ids, and the lineage is cut before the wide stages.
    ided = (
        rows.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_pid", F.shiftright("_id", 33))
        .checkpoint(eager=True)
    )
    before = Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        ided.groupBy(key, "_pid")
        .agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .select(key, "_pid", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    # one row per (key, task) that holds rows of the key; counted, not guessed
    blocks = blocks.withColumnsRenamed({key: "_block_key", "_pid": "_block"}).checkpoint(eager=True)
    if blocks.count() <= MAX_BROADCAST_ROWS:
        blocks = F.broadcast(blocks)
    same = ided[key].eqNullSafe(F.col("_block_key")) & (F.col("_pid") == F.col("_block"))
    return ided.join(blocks, same).withColumn(
        name, F.col("_offset") + F.col("_id") - F.col("_first")
    ).drop("_id", "_pid", "_first", "_offset", "_block_key", "_block")


def row_positions(df: DataFrame, key: str, order: Sequence[str], threshold: int | None,
                  name: str = "k") -> DataFrame:
    """``row_number() - 1`` per key in ``order``, split for keys over ``threshold`` rows."""
    plain = df.withColumn(name, F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1)
    if threshold is None:
        return plain
    hot = hot_keys(df, key, threshold)
    n_hot = hot.count()
    if n_hot == 0:
        return plain
    cold, heavy = split_by_key(df, hot, key, n_hot)
    cold = cold.withColumn(name, F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1)
    heavy = global_positions(heavy, key, order, n_hot, name)
    return cold.unionByName(heavy.withColumn(name, F.col(name).cast("int")))


def row_places(ordered: DataFrame, name: str = "POS") -> DataFrame:
    """0-based place of every row of an ordered frame (partitions in order, rows in order inside).

    Only one count per partition is summed up; the rows stay where they are.
    """
    checkpoint_root(ordered.sparkSession)
    ided = ordered.withColumn("_id", F.monotonically_increasing_id()).withColumn(
        "_pid", F.shiftright("_id", 33)).checkpoint(eager=True)
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ided.groupBy("_pid").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")).select(
        F.col("_pid").alias("_part"), "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return ided.join(F.broadcast(offsets), F.col("_pid") == F.col("_part")).withColumn(
        name, F.col("_offset") + F.col("_id") - F.col("_first")
    ).drop("_id", "_pid", "_part", "_first", "_offset")
