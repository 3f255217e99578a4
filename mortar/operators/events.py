"""First-event extraction from the enriched panel.

The enriched panel is already hash-partitioned by ``LOAN_ID`` and sorted by
time, so per-loan aggregates and windows over it add no exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import checkpoint_root
from .panel import loan_window, order_of
from .skew import split_by_key


def first_per_loan(panel: DataFrame, condition: Column, fields: list[Column],
                   order: Sequence[str] | None = None, method: str = "min_by") -> DataFrame:
    """For each loan, ``fields`` of its earliest row meeting ``condition``.

    ``min_by`` (default): ``min_by`` over the time key is a partial
    aggregate; each task keeps one candidate per loan before any shuffle, so
    a loan with a huge history is never gathered into one task, and on a
    panel already partitioned by ``LOAN_ID`` no exchange is added.

    ``row_number`` (W9/W10 + F5): number the matching rows per loan in time
    order and keep ``rn == 1``; Catalyst adds a per-group limit before the
    sort.  Same rows; it needs the whole loan in one task.
    """
    order = order or order_of(panel)
    if method == "row_number":
        return (
            panel.where(condition)
            .withColumn("_rn", F.row_number().over(loan_window(order)))
            .where(F.col("_rn") == 1)
            .select("LOAN_ID", *fields)
        )
    key = F.struct(*[F.col(c) for c in order])
    return (
        panel.where(condition)
        .groupBy("LOAN_ID")
        .agg(F.min_by(F.struct(*fields), key).alias("_e"))
        .select("LOAN_ID", "_e.*")
    )


# --- fixed values: output names of the event tables and their panel columns ---
MOD_NAMES = (
    ("MOD_DTE", "ACT_DTE"), ("MOD_AGE", "LOAN_AGE"), ("MOD_DLQ", "DLQ_STATUS"), ("MOD_DLQ_LAG", "DLQ_LAG"),
    ("MOD_DLQ_LAGs12", "DLQ_LAGs12"), ("MOD_POST_MAXDLQ_12", "DLQ_NEXT12MAX"),
    ("MOD_POST_MAXDLQ_24", "DLQ_NEXT24MAX"), ("MOD_POST_ZBCODE_12", "ZBCODE_NEXT12"),
    ("MOD_POST_ZBCODE_24", "ZBCODE_NEXT24"),
)
F3Q_NAMES = (
    ("F3Q_DTE", "ACT_DTE"), ("F3Q_AGE", "LOAN_AGE"), ("F3Q_DLQ_LAGs12", "DLQ_LAGs12"),
    ("F3Q_POST_MAXDLQ_12", "DLQ_NEXT12MAX"), ("F3Q_POST_MAXDLQ_24", "DLQ_NEXT24MAX"),
    ("F3Q_POST_ZBCODE_12", "ZBCODE_NEXT12"), ("F3Q_POST_ZBCODE_24", "ZBCODE_NEXT24"),
)
ZB_NAMES = (
    ("ZB_CODE", "ZB_CODE"), ("ZB_DTE", "ZB_DTE"), ("ZB_AGE", "LOAN_AGE"), ("ZB_DLQ_LAGs12", "DLQ_LAGs12"),
    ("ZB_DLQ_LAG", "DLQ_LAG"), ("ZB_LAST_UPB", "LAST_UPB"), ("LPI_DTE", "LPI_DTE"), ("FCC_DTE", "FCC_DTE"),
    ("DISP_DTE", "DISP_DTE"), ("DEFT_COST", "DEFT_COST"), ("DEFT_PROCS", "DEFT_PROCS"),
)
SERIOUS_DLQ = 2  # status above this = 90 days or more past due
# --- end of fixed values --------------------------------------------------------


def _fields(names: Sequence[tuple[str, str]], panel: DataFrame) -> list[Column]:
    """The named columns; an event date that the agency's tape lacks is null."""
    return [(F.col(src) if src in panel.columns else F.lit(None).cast("date")).alias(out) for out, src in names]


def _is_mod() -> Column:
    return F.col("MOD_FLAG") == "Y"


def _is_serious() -> Column:
    return F.col("DLQ_STATUS") > SERIOUS_DLQ


def has_event() -> Column:
    """Rows that are a modification, a serious delinquency or a liquidation."""
    return F.coalesce(_is_mod() | _is_serious(), F.lit(False)) | F.col("ZB_CODE").isNotNull()


def first_modification(panel: DataFrame, order: Sequence[str] | None = None, method: str = "min_by") -> DataFrame:
    """First month with ``MOD_FLAG = 'Y'``."""
    return first_per_loan(panel, _is_mod(), _fields(MOD_NAMES, panel), order, method)


def first_serious_delinquency(panel: DataFrame, order: Sequence[str] | None = None,
                              method: str = "min_by") -> DataFrame:
    """First month 90 days or more past due."""
    return first_per_loan(panel, _is_serious(), _fields(F3Q_NAMES, panel), order, method)


def zero_balance_events(panel: DataFrame) -> DataFrame:
    """Every row with a zero-balance code (not only the first)."""
    return panel.where(F.col("ZB_CODE").isNotNull()).select("LOAN_ID", *_fields(ZB_NAMES, panel))


def _first_struct(condition: Column, fields: list[Column], order: Sequence[str]) -> Column:
    """The loan's earliest row meeting ``condition``, as a struct (null if none)."""
    whole = loan_window(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return F.first(F.when(condition, F.struct(*fields)), ignorenulls=True).over(whole)


def loan_events(panel: DataFrame, order: Sequence[str] | None = None, hot: DataFrame | None = None,
                n_hot: int = 0) -> DataFrame:
    """E1 + E2 + E3 in one table: one row per (loan, zero-balance row).

    Equivalent to the event universe left-joined to the first modification,
    the first 90-day delinquency and all zero-balance rows.  Loans with a
    modification or delinquency but no zero-balance row keep one row with
    null zero-balance columns.

    A second window over the panel's existing partitioning and order gives
    all three, so the monthly tape is shuffled once in total.  Loans named in
    ``hot`` (too large for one task) take partial aggregates instead, which
    never gather a loan in one place; the others keep the window.
    """
    order = order or order_of(panel)
    if hot is None or not n_hot:
        return _events_by_window(panel, order)
    cold, heavy = split_by_key(panel, hot, "LOAN_ID", n_hot)
    return _events_by_window(cold, order).unionByName(_events_by_aggregation(heavy, order))


def _events_by_window(panel: DataFrame, order: Sequence[str]) -> DataFrame:
    whole = loan_window(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    is_zb = F.col("ZB_CODE").isNotNull()
    zb = _fields(ZB_NAMES, panel)
    staged = panel.select(
        "LOAN_ID",
        _first_struct(_is_mod(), _fields(MOD_NAMES, panel), order).alias("_mod"),
        _first_struct(_is_serious(), _fields(F3Q_NAMES, panel), order).alias("_f3q"),
        F.count(F.col("ZB_CODE")).over(whole).alias("_n_zb"),
        F.row_number().over(loan_window(order)).alias("_rn"),
        is_zb.alias("_is_zb"),
        F.struct(*zb).alias("_zb"),
    )
    keep = F.col("_is_zb") | (
        (F.col("_n_zb") == 0) & (F.col("_rn") == 1) & (F.col("_mod").isNotNull() | F.col("_f3q").isNotNull())
    )
    return staged.where(keep).select(
        "LOAN_ID", "_mod.*", "_f3q.*",
        *[F.when(F.col("_is_zb"), F.col(f"_zb.{n}")).alias(n) for n, _ in ZB_NAMES],
    )


def _events_by_aggregation(panel: DataFrame, order: Sequence[str]) -> DataFrame:
    """Partial aggregates per hot loan, left-joined to its liquidation rows.

    The hot loans' event rows feed both sides, so they are checkpointed to
    the shared folder and the panel is planned once.
    """
    checkpoint_root(panel.sparkSession)
    key = F.struct(*[F.col(c) for c in order])
    events = panel.where(has_event()).checkpoint(eager=True)
    firsts = events.groupBy("LOAN_ID").agg(
        F.min_by(F.struct(*_fields(MOD_NAMES, panel)), F.when(_is_mod(), key)).alias("_mod"),
        F.min_by(F.struct(*_fields(F3Q_NAMES, panel)), F.when(_is_serious(), key)).alias("_f3q"),
    )
    # a left join keeps one row with null zero-balance columns where there is none
    return firsts.join(zero_balance_events(events), "LOAN_ID", "left").select(
        "LOAN_ID", "_mod.*", "_f3q.*", *[n for n, _ in ZB_NAMES])
