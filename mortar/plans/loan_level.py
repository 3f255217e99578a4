"""The loan-level plan: cleaned tapes -> enriched panel -> events -> outcome.

Frames are lazy but for two small things asked of the monthly rows when the
panel is first used: the count of loans too long for one task and, only if
there are any, the checkpoints that split them.  Loan ids that are null are
kept out of the plan and listed by ``rejected_months``.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from ..operators.clean import clean_acquisition, keep_columns, performance_base
from ..operators.events import first_modification, first_serious_delinquency, loan_events, zero_balance_events
from ..operators.outcome import event_universe, loan_outcome, universe_outcome
from ..operators.panel import CHUNK_ROWS, HOT_LOAN_ROWS, enrich_panel, hot_loans
from ..operators.schedule import panel_with_schedule, rejected_loans
from ..schema import Agency, agency as agency_of
from ..session import remove_path, scratch_path
from ..sinks.parquet import save_vintage, sorted_for_sink


@dataclass
class LoanLevel:
    """Lazy frames of one agency's loan-level build."""

    agency: Agency
    perf_base: DataFrame
    loans: DataFrame | None = None
    month_count: int | None = 12
    hot_threshold: int | None = HOT_LOAN_ROWS
    chunk_rows: int = CHUNK_ROWS

    @property
    def months(self) -> DataFrame:
        """Monthly rows that belong to a loan."""
        return self.perf_base.where(F.col("LOAN_ID").isNotNull())

    @property
    def rejected_months(self) -> DataFrame:
        """Monthly rows without a loan id, with the reason."""
        return self.perf_base.where(F.col("LOAN_ID").isNull()).withColumn("REASON", F.lit("no loan id"))

    @property
    def rejected_loans(self) -> DataFrame | None:
        """Loans without usable terms, with the reason."""
        return None if self.loans is None else rejected_loans(self.loans)

    @cached_property
    def n_hot(self) -> int:
        """Loans too long for one task (normally 0); one small scalar job."""
        if self.hot_threshold is None:
            return 0
        return hot_loans(self.months, self.hot_threshold).count()

    @cached_property
    def panel(self) -> DataFrame:
        return enrich_panel(self.months, hot_threshold=self.hot_threshold, chunk_rows=self.chunk_rows,
                            n_hot=self.n_hot)

    @cached_property
    def first_mod(self) -> DataFrame:
        return first_modification(self.panel)

    @cached_property
    def first_90d(self) -> DataFrame:
        return first_serious_delinquency(self.panel)

    @cached_property
    def zero_balance(self) -> DataFrame:
        return zero_balance_events(self.panel)

    @property
    def universe(self) -> DataFrame:
        return event_universe(self.months)

    @cached_property
    def events(self) -> DataFrame:
        """All three event tables in one pass (one row per loan and liquidation)."""
        hot = hot_loans(self.months, self.hot_threshold) if self.n_hot else None
        return loan_events(self.panel, hot=hot, n_hot=self.n_hot)

    def outcome(self, ordered: bool = False) -> DataFrame:
        """Loan tape with its events; the event universe when no tape is loaded.

        Built from the single-pass event table: same rows as joining the
        three event tables one by one, with one shuffle of the panel.
        """
        if self.loans is None:
            return self.events
        out = self.loans.join(self.events, "LOAN_ID", "left")
        return out.orderBy("LOAN_ID") if ordered else out

    def outcome_by_joins(self, ordered: bool = False) -> DataFrame:
        """The same outcome as three successive left joins."""
        if self.loans is None:
            return universe_outcome(self.universe, self.first_mod, self.first_90d, self.zero_balance)
        return loan_outcome(self.loans, self.first_mod, self.first_90d, self.zero_balance, ordered)

    def performance(self, ordered: bool = False) -> DataFrame | None:
        """Keep-list panel with LAST_UPB filled from the schedule.

        The schedule is computed from the loan tape itself, before any event
        join, so repeated zero-balance rows never duplicate panel rows.
        Without a loan tape there is no schedule and None is returned.
        """
        if self.loans is None:
            return None
        panel = keep_columns(self.months, self.agency.performance)
        return panel_with_schedule(panel, self.loans, self.month_count, ordered)


def save(level: LoanLevel, folder: str, vintage: str, loan: bool = True, performance: bool = True) -> dict:
    """S8 for a whole build: ``<folder>/<agency>/Loan.parquet/ACQ=<vintage>``
    (the outcome) and ``.../LoanPerformance.parquet/ACQ=<vintage>`` (the
    scheduled panel).  Only that vintage is replaced; each file is sorted by
    its keys within the task that writes it.

    The monthly tape is parsed once, into a Parquet copy in the scratch
    folder; the hot-loan count, the outcome and the scheduled panel read the
    columns they need from there.
    """
    paths = {}
    spark = level.perf_base.sparkSession
    staged = scratch_path(spark, "save-months")
    level.perf_base.write.parquet(staged)
    level = replace(level, perf_base=spark.read.parquet(staged))
    if loan:
        paths["Loan"] = save_vintage(sorted_for_sink(level.outcome(), ["LOAN_ID"], total_order=False),
                                     folder, level.agency.name, "Loan", vintage)
    perf = level.performance() if performance else None
    if perf is not None:
        paths["LoanPerformance"] = save_vintage(
            sorted_for_sink(perf, ["LOAN_ID", "ACT_DTE"], total_order=False),
            folder, level.agency.name, "LoanPerformance", vintage)
    remove_path(spark, staged)
    return paths


def build(perf_raw: DataFrame, loans_raw: DataFrame | None = None, agency: str | Agency = "FNMA",
          month_count: int | None = 12, hot_threshold: int | None = HOT_LOAN_ROWS,
          chunk_rows: int = CHUNK_ROWS) -> LoanLevel:
    """Clean both tapes and wire the loan-level plan."""
    ag = agency if isinstance(agency, Agency) else agency_of(agency)
    loans = clean_acquisition(loans_raw, ag) if loans_raw is not None else None
    return LoanLevel(ag, performance_base(perf_raw, ag), loans, month_count, hot_threshold, chunk_rows)
