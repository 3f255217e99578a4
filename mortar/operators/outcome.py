"""Loan-level outcome table: loans left-joined to their events.

All joins are on ``LOAN_ID``.  The event tables come out of the panel's
window stage already hash-partitioned by ``LOAN_ID``, so only the loan tape
is shuffled; adaptive execution turns a join into a broadcast only when the
runtime size of a side is under the configured threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .events import has_event


def event_universe(perf: DataFrame) -> DataFrame:
    """Distinct loans that have any event.

    Whether a month is an event depends on its own row only, so one filter
    over the monthly rows and a partial distinct do; no window is needed.
    """
    return perf.where(has_event()).select("LOAN_ID").distinct()


def attach_events(base: DataFrame, mod: DataFrame, f3q: DataFrame, zb: DataFrame) -> DataFrame:
    """Left joins on LOAN_ID; the zero-balance join is 1:N."""
    return (
        base.join(mod, "LOAN_ID", "left")
        .join(f3q, "LOAN_ID", "left")
        .join(zb, "LOAN_ID", "left")
    )


def loan_outcome(loans: DataFrame, mod: DataFrame, f3q: DataFrame, zb: DataFrame,
                 ordered: bool = False) -> DataFrame:
    """Loan tape with first modification, first 90-day delinquency, liquidation.

    ``ordered`` adds the total order by LOAN_ID (a range exchange); leave it
    to the sink unless a sorted frame is really needed.
    """
    out = attach_events(loans, mod, f3q, zb)
    return out.orderBy("LOAN_ID") if ordered else out


def universe_outcome(universe: DataFrame, mod: DataFrame, f3q: DataFrame, zb: DataFrame) -> DataFrame:
    """Outcome rows for the event universe when no loan tape is loaded."""
    return attach_events(universe, mod, f3q, zb)


def loan_with(loans: DataFrame, events: DataFrame) -> DataFrame:
    """Single left join of the loan tape with one event table."""
    return loans.join(events, "LOAN_ID", "left")


def max_age(panel: DataFrame) -> DataFrame:
    """G1: the panel's largest loan age."""
    return panel.agg(F.max("LOAN_AGE").alias("max_age"))
