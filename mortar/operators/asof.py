"""As-of join: the last value known at a time, by union, sort and carry-forward.

There is no inequality join.  The distinct (key, time) pairs of the left side
are put among the right side's rows, sorted, and every pair takes the last
right row before or at it; the result goes back to the left rows by equality.
Left rows that share a key and time (a month of all loans) are asked for once,
so the left side is neither sorted nor shuffled by time.

A key with a large share of the pairs is spread over many tasks: rows are
range-partitioned by key and time, filled inside each task, and the last value
of each task is carried into the following ones through a table of one row
per key and task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..session import checkpoint_root
from .skew import MAX_BROADCAST_ROWS

# Keys with more (key, time) pairs than this are filled by the split path.
HOT_PAIRS = 1_000_000


def _filled(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn(value, F.last(value, ignorenulls=True).over(w))


def _filled_across_tasks(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    by = [*keys, *order]
    checkpoint_root(rows.sparkSession)
    # read by the fill and by the table of task ends: both must see the same tasks
    ided = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(
        "_id", F.monotonically_increasing_id()).withColumn("_pid", F.shiftright("_id", 33)).checkpoint(eager=True)
    local = _filled(ided, [*keys, "_pid"], ["_id"], value)
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    ends = ided.groupBy(*keys, "_pid").agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.col("_id"))).alias("_end"))
    carried = ends.select(*[F.col(k).alias(f"_c{i}") for i, k in enumerate(keys)], F.col("_pid").alias("_cp"),
                          F.last("_end", ignorenulls=True).over(before).alias("_carried")).checkpoint(eager=True)
    if carried.count() <= MAX_BROADCAST_ROWS:
        carried = F.broadcast(carried)
    same = F.col("_pid") == F.col("_cp")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_c{i}"))
    return local.join(carried, same).withColumn(value, F.coalesce(value, "_carried")).select(*rows.columns)


def carry_forward(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                  hot_threshold: int | None = HOT_PAIRS) -> DataFrame:
    """``rows`` with null ``value``s replaced by the last one before them; ``order`` is total per key."""
    if hot_threshold is not None:
        hot = rows.groupBy(*keys).count().where(F.col("count") > hot_threshold).limit(1).count()
        if hot:
            return _filled_across_tasks(rows, keys, order, value)
    return _filled(rows, keys, order, value)


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str,
              values: Sequence[str], hot_threshold: int | None = HOT_PAIRS) -> DataFrame:
    """``left`` with ``right_time`` and ``values`` of the right row in force at ``left_time``.

    The right row is the last of the same keys at or before ``left_time``;
    null without one, or where a key or the time is null.  A time that the
    right side repeats counts with its greatest values.
    """
    known = [F.col(k).isNotNull() for k in keys]

    def kept(df: DataFrame, time: str) -> DataFrame:
        for c in [*known, F.col(time).isNotNull()]:
            df = df.where(c)
        return df
    found = F.struct(F.col("_t").alias(right_time), *values)
    quotes = kept(right, right_time).select(*keys, F.col(right_time).alias("_t"), *values).groupBy(*keys, "_t").agg(
        F.max(found).alias("_v")).withColumn("_asked", F.lit(0))
    pairs = kept(left, left_time).select(*keys, F.col(left_time).alias("_t")).distinct().withColumn("_asked", F.lit(1))
    filled = carry_forward(quotes.unionByName(pairs, allowMissingColumns=True), keys, ["_t", "_asked"], "_v", hot_threshold)
    checkpoint_root(left.sparkSession)
    answers = filled.where((F.col("_asked") == 1) & F.col("_v").isNotNull()).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_t").alias("_at"), "_v").checkpoint(eager=True)
    if answers.count() <= MAX_BROADCAST_ROWS:
        answers = F.broadcast(answers)
    same = left[left_time] == F.col("_at")
    for i, k in enumerate(keys):
        same = same & (left[k] == F.col(f"_k{i}"))
    names = [right_time, *values]
    return left.join(answers, same, "left").select(
        *[left[c] for c in left.columns if c not in names], *[F.col("_v")[n].alias(n) for n in names])
