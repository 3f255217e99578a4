"""Calendar-month versions of the look-back and look-ahead columns.

The frames of ``operators.panel`` count reported rows; these count calendar
months, so that a missing month does not stretch "the next 12" and a month
reported twice does not shrink it.  A month counts once, with its worst
status, and the look-back array has one slot per calendar month (null where
the loan did not report).

An ordinary loan is one window partition, as in the panel.  A loan with very
many rows is first brought down to one row per month by partial aggregates:
however many rows a month has, a loan has few months.  The windows run over
those, and the rows take their month's result by equality.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.months import month_number
from .panel import HOT_LOAN_ROWS, LOAN_KEY, LOOK_AHEAD_LONG, LOOK_AHEAD_SHORT, LOOK_BACK, hot_loans
from .skew import MAX_BROADCAST_ROWS, split_by_key

CALENDAR_COLUMNS = (
    "DLQ_LAG_cal", "DLQ_LAGs12_cal", "DLQ_NEXT12MAX_cal", "DLQ_NEXT24MAX_cal",
    "ZBCODE_NEXT12_cal", "ZBCODE_NEXT24_cal", "MOD_NEXT12_cal", "MOD_NEXT24_cal",
)
_READ = ("DLQ_STATUS", "ZB_CODE", "MOD_FLAG")


def calendar_columns(month: str = "_month") -> list[Column]:
    """The eight columns over one window of month numbers; null where the month is unknown."""
    w = Window.partitionBy(LOAN_KEY).orderBy(month)

    def most(c: str, first: int, last: int) -> Column:
        return F.max(c).over(w.rangeBetween(first, last))
    made = [
        most("DLQ_STATUS", -1, -1),
        F.array(*[most("DLQ_STATUS", -k, -k) for k in range(LOOK_BACK, 0, -1)]),
        *[most(c, 1, ahead) for c in _READ for ahead in (LOOK_AHEAD_SHORT, LOOK_AHEAD_LONG)],
    ]
    return [F.when(F.col(month).isNotNull(), c).alias(n) for n, c in zip(CALENDAR_COLUMNS, made)]


def _by_month(rows: DataFrame) -> DataFrame:
    """The same columns for loans of very many rows, through one row per loan and month."""
    monthly = rows.where(F.col("_month").isNotNull()).groupBy(LOAN_KEY, "_month").agg(
        *[F.max(c).alias(c) for c in _READ])
    found = monthly.select(F.col(LOAN_KEY).alias("_lid"), F.col("_month").alias("_at"), *calendar_columns())
    if found.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS:
        found = F.broadcast(found)
    same = F.col(LOAN_KEY).eqNullSafe(F.col("_lid")) & (F.col("_month") == F.col("_at"))
    return rows.join(found, same, "left").drop("_lid", "_at")


def enrich_calendar(perf: DataFrame, hot_threshold: int | None = HOT_LOAN_ROWS, n_hot: int | None = None) -> DataFrame:
    """``perf`` (see ``performance_base``) with the eight ``*_cal`` columns."""
    rows = perf.withColumn("_month", month_number("ACT_DTE"))
    if hot_threshold is not None and n_hot is None:
        n_hot = hot_loans(perf, hot_threshold).count()
    if not n_hot:
        return rows.select("*", *calendar_columns()).drop("_month")
    cold, heavy = split_by_key(rows, hot_loans(perf, hot_threshold), LOAN_KEY, n_hot)
    return cold.select("*", *calendar_columns()).unionByName(_by_month(heavy)).drop("_month")
