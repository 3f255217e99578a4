"""Scheduled balances and payment tables.

Balances come from the closed form in ``functions.amortize``: each
(loan, month) cell is one expression, so the long schedule is the loan tape
times a generated month sequence, and the panel's scheduled balance is
computed in place after joining the loan terms by ``LOAN_ID`` (no join on
an exploded schedule).

The month count N is a property of the whole loan set (the longest term,
capped by the requested horizon); it is a scalar subquery, evaluated once by
Spark and inlined as a literal, not collected by this code.
"""

from __future__ import annotations

import sys
from functools import partial

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from ..functions.amortize import BEYOND_TERM, balance, balance_by_principal_parts, level_payment, masked_balance
from ..functions.cleaning import monthly_rate
from ..session import parallelism

LOAN_TERMS = ("LOAN_ID", "ORIG_AMT", "ORIG_RT", "ORIG_TRM")


def _longest_term(loans: DataFrame) -> Column:
    """The longest usable term (a corrupt one would give every loan its months)."""
    return loans.where(unusable_terms().isNull()).select(F.max("ORIG_TRM")).scalar()


def month_count(loans: DataFrame, start_period: int = 0, end_period: int | None = None) -> Column:
    """M5: N = longest usable term, capped at max(1, end - start) when an end is given."""
    n = _longest_term(loans)
    if end_period is not None:
        n = F.least(n, F.lit(max(1, end_period - start_period)))
    return n


def horizon(loans: DataFrame, max_month: int | None = None) -> Column:
    """N = max(1, max_month), or the longest usable term when no month count is given."""
    if max_month is None:
        return _longest_term(loans)
    return F.lit(max(1, max_month))


def _months(n: Column) -> Column:
    """0 .. N-1; null (no month) when no loan has a term of a month or more."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1))


def _terms(loans: DataFrame) -> DataFrame:
    return loans.select(
        "LOAN_ID",
        F.col("ORIG_AMT").cast("double").alias("_P"),
        monthly_rate("ORIG_RT").cast("double").alias("_r"),
        F.col("ORIG_TRM").alias("_n"),
    )


def _cell(i: Column, start_period: int) -> Column:
    """M3/M4: column 0 is the unmasked B(start); later columns are masked."""
    t = i + F.lit(start_period)
    return F.when(i == 0, balance("_P", "_r", "_n", t)).otherwise(masked_balance("_P", "_r", "_n", t))


def schedule_long(loans: DataFrame, month_count_: int | None = 12, start_period: int = 0) -> DataFrame:
    """M2/M3/M5/M7: (LOAN_ID, LOAN_AGE, SCHD_UPB) for LOAN_AGE = start .. start+N-1.

    ``month_count_`` is the requested end period (the reference calls it
    monthCount); None means the longest term in the set.
    """
    end = None if month_count_ is None else start_period + month_count_
    n = month_count(loans, start_period, end) if end is not None else month_count(loans)
    t = _terms(loans)
    i = F.col("_i")
    return (
        t.select("*", F.explode(_months(n)).alias("_i"))
        .select(
            "LOAN_ID",
            (i + F.lit(start_period)).cast("int").alias("LOAN_AGE"),
            _cell(i, start_period).alias("SCHD_UPB"),
        )
    )


def schedule_wide(loans: DataFrame, month_count_: int | None = 12, start_period: int = 0) -> DataFrame:
    """M6: one row per loan with the N balances as an array."""
    end = None if month_count_ is None else start_period + month_count_
    n = month_count(loans, start_period, end) if end is not None else month_count(loans)
    # A subquery may not sit inside a lambda: bind N to a column first.
    t = _terms(loans).select("*", n.alias("_months"))
    return t.select(
        "LOAN_ID",
        F.transform(_months(F.col("_months")), lambda i: _cell(i, start_period))
        .alias("SCHD_UPB"),
    )


def schedule_ppmt(loans: DataFrame, max_month: int | None = 12) -> DataFrame:
    """M8: principal less the principal parts of payments 1..t, no mask."""
    n = horizon(loans, max_month)
    t = _terms(loans)
    i = F.col("_i")
    return t.select("*", F.explode(_months(n)).alias("_i")).select(
        "LOAN_ID",
        i.cast("int").alias("LOAN_AGE"),
        balance_by_principal_parts("_P", "_r", "_n", i).alias("SCHD_UPB"),
    )


def schedule_unmasked(loans: DataFrame, max_month: int | None = 12) -> DataFrame:
    """M9: the balance recurrence run past the term (goes below zero), no mask."""
    n = horizon(loans, max_month)
    t = _terms(loans)
    i = F.col("_i")
    return t.select("*", F.explode(_months(n)).alias("_i")).select(
        "LOAN_ID",
        i.cast("int").alias("LOAN_AGE"),
        balance("_P", "_r", "_n", i).alias("SCHD_UPB"),
    )


def with_level_payment(loans: DataFrame) -> DataFrame:
    """M1: the level monthly payment of every loan."""
    return loans.select(
        *LOAN_TERMS,
        level_payment("ORIG_AMT", monthly_rate("ORIG_RT"), "ORIG_TRM").alias("PMT"),
    )


def _one_set(loans: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """LOAN_ID, ``_same`` (whether the loan's rows agree) and the least of each column.

    Columns are compared one by one: minima and maxima of numbers are summed
    up in a hash table, where a struct of them would be sorted.
    """
    sums, same = [], F.lit(True)
    for c in columns:
        sums += [F.min(c).alias(f"_a_{c}"), F.max(c).alias(f"_b_{c}"), F.count(c).alias(f"_n_{c}")]
        n = F.col(f"_n_{c}")
        same = same & ((n == 0) | ((n == F.col("_rows")) & (F.col(f"_a_{c}") == F.col(f"_b_{c}"))))
    one = loans.where(F.col("LOAN_ID").isNotNull()).groupBy("LOAN_ID").agg(F.count(F.lit(1)).alias("_rows"), *sums)
    return one.select("LOAN_ID", same.alias("_same"), *[F.col(f"_a_{c}").alias(c) for c in columns])


def one_row_per_loan(loans: DataFrame, *columns: str) -> DataFrame:
    """LOAN_ID and ``columns``; a loan repeated with other values is left out (``rejected_loans`` lists terms)."""
    return _one_set(loans, columns).where("_same").drop("_same")


def scheduled_balance_at_age(panel: DataFrame, loans: DataFrame, month_count_: int | None = 12) -> DataFrame:
    """J5 without the exploded join: SCHD_UPB = B(LOAN_AGE) for 0 <= age < N.

    Same result as joining the long schedule on (LOAN_ID, LOAN_AGE): ages
    outside 0..N-1 or loans missing from the tape get null.  ``month_count_``
    None means the longest usable term of the tape.  The panel is joined with
    one row per loan: a loan that the tape repeats (for example in two
    vintages) with its terms counts once, one that it repeats with other
    terms has no schedule and is listed by ``rejected_loans``.
    """
    n = month_count(loans, 0, month_count_) if month_count_ is not None else month_count(loans)
    t = one_row_per_loan(_terms(loans), "_P", "_r", "_n").withColumnRenamed("LOAN_ID", "_lid")
    age = F.col("LOAN_AGE")
    joined = panel.join(t, panel["LOAN_ID"] == t["_lid"], "left")
    schd = F.when((age >= 0) & (age < n), _cell(age, 0))
    return joined.select(*[panel[c] for c in panel.columns], schd.alias("SCHD_UPB"))


def panel_with_schedule(panel: DataFrame, loans: DataFrame, month_count_: int | None = 12,
                        ordered: bool = False) -> DataFrame:
    """J5 + P10 + F1: fill missing LAST_UPB with the scheduled balance (3 places).

    Past the term the schedule holds -999; such rows keep a null balance.

    ``month_count_`` is the requested horizon (12 in the published plan: ages
    beyond it are not filled); None fills the whole term.
    """
    schd = F.col("SCHD_UPB")
    # The -999 "beyond the term" marker is not a balance: it fills nothing.
    fill = F.when(schd != F.lit(BEYOND_TERM), F.round(schd, 3))
    out = (
        scheduled_balance_at_age(panel, loans, month_count_)
        .where(F.col("LOAN_AGE") >= 0)
        .withColumn("LAST_UPB", F.coalesce(F.col("LAST_UPB"), fill))
        .drop("SCHD_UPB")
    )
    return out.orderBy("LOAN_ID", "ACT_DTE") if ordered else out


# --- payment table ------------------------------------------------------------

# The NumPy kernel below runs in executors' Python workers.  Pickling this
# module's functions by value ships them with the task, so executors need
# only NumPy and pyarrow, not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAYMENT_SCHEMA = T.StructType([
    T.StructField("LOAN_ID", T.StringType()),
    T.StructField("PMT_NO", T.IntegerType()),
    T.StructField("BEG_BAL", T.DoubleType()),
    T.StructField("PAYMENT", T.DoubleType()),
    T.StructField("PRINCIPAL", T.DoubleType()),
    T.StructField("INTEREST", T.DoubleType()),
    T.StructField("END_BAL", T.DoubleType()),
])

# Computed amounts of the payment table (high entropy: no dictionary pays off).
PAYMENT_MONEY = ("BEG_BAL", "PAYMENT", "PRINCIPAL", "INTEREST", "END_BAL")

# Output rows per NumPy block.
_BLOCK_ROWS = 250_000
# Tasks of the payment table a slot: short enough to even out, few enough to start fast.
TASKS_PER_SLOT = 4
# Longest usable term in months; longer ones are rejected as corrupt.
MAX_TERM = 1200


def _round_cents(x: np.ndarray) -> np.ndarray:
    # Same IEEE steps as functions.cleaning.round_half_up(x, 2).
    return np.floor(x * 100.0 + 0.5) / 100.0


def _payment_columns(p: np.ndarray, rate: np.ndarray, n: np.ndarray, round_payment: bool = False):
    """Payment rows of a block of loans, loan-major, as NumPy columns.

    Vectorised over the loans, sequential over months: at month k only the
    loans whose term reaches k are updated.
    """
    r = rate / 1200.0
    with np.errstate(divide="ignore", invalid="ignore"):
        pay = np.where(r == 0, p / n, p * (r / (1.0 - (1.0 + r) ** (-n.astype(np.float64)))))
    if round_payment:
        pay = _round_cents(pay)
    total = int(n.sum())
    start = np.zeros(len(n), np.int64)
    np.cumsum(n[:-1], out=start[1:])
    out_no = np.empty(total, np.int32)
    out_beg = np.empty(total)
    out_int = np.empty(total)
    out_prn = np.empty(total)
    out_end = np.empty(total)
    bal = p.astype(np.float64).copy()
    active = np.arange(len(p))
    for k in range(1, int(n.max()) + 1 if len(n) else 1):
        active = active[n[active] >= k]
        if active.size == 0:
            break
        b = bal[active]
        interest = _round_cents(b * r[active])
        applied = pay[active] - interest
        end = b - applied
        pos = start[active] + (k - 1)
        out_no[pos] = k
        out_beg[pos] = b
        out_int[pos] = interest
        out_prn[pos] = applied
        out_end[pos] = end
        bal[active] = end
    return out_no, out_beg, np.repeat(pay, n), out_prn, out_int, out_end


def _payment_batches(batches, round_payment: bool = False):
    import pyarrow as pa

    schema = pa.schema([
        ("LOAN_ID", pa.string()), ("PMT_NO", pa.int32()), ("BEG_BAL", pa.float64()),
        ("PAYMENT", pa.float64()), ("PRINCIPAL", pa.float64()), ("INTEREST", pa.float64()),
        ("END_BAL", pa.float64()),
    ])
    for rb in batches:
        terms = rb.column("ORIG_TRM").to_numpy(zero_copy_only=False).astype(np.int64)
        # a block ends where its rows (the sum of its terms) reach _BLOCK_ROWS
        block = (np.cumsum(terms) - terms) // _BLOCK_ROWS
        starts = np.flatnonzero(np.diff(block, prepend=-1))
        for lo, hi in zip(starts, np.append(starts[1:], rb.num_rows)):
            b = rb.slice(int(lo), int(hi - lo))
            n = b.column("ORIG_TRM").to_numpy(zero_copy_only=False).astype(np.int64)
            cols = _payment_columns(
                b.column("ORIG_AMT").to_numpy(zero_copy_only=False).astype(np.float64),
                b.column("ORIG_RT").to_numpy(zero_copy_only=False).astype(np.float64),
                n,
                round_payment,
            )
            ids = b.column("LOAN_ID").take(pa.array(np.repeat(np.arange(b.num_rows), n)))
            yield pa.RecordBatch.from_arrays([ids, *[pa.array(c) for c in cols]], schema=schema)


def unusable_terms() -> Column:
    """Why a loan has no schedule; null for a usable one."""
    trm = F.col("ORIG_TRM")
    return (
        F.when(F.col("LOAN_ID").isNull(), "no loan id")
        .when(F.col("ORIG_AMT").isNull(), "no amount")
        .when(F.col("ORIG_RT").isNull(), "no rate")
        .when(trm.isNull(), "no term")
        .when(trm <= 0, "term below one month")
        .when(trm > MAX_TERM, "term too long")
    )


def rejected_loans(loans: DataFrame) -> DataFrame:
    """Loan rows that no schedule or payment table can use, with the reason.

    Rows of a loan that comes with several sets of terms have no place in the
    scheduled panel (which has one row per loan and month); payment tables
    take every usable row by itself.
    """
    rows = loans.select(*LOAN_TERMS, unusable_terms().alias("REASON"))
    several = _one_set(loans, LOAN_TERMS[1:]).where(~F.col("_same")).select("LOAN_ID")
    both = rows.where(F.col("REASON").isNull()).drop("REASON").join(several, "LOAN_ID", "left_semi")
    return rows.where(F.col("REASON").isNotNull()).unionByName(
        both.select(*LOAN_TERMS, F.lit("several sets of terms").alias("REASON")))


def payment_table(loans: DataFrame, rows_per_task: int | None = None, round_payment: bool = False) -> DataFrame:
    """One row per scheduled payment of every loan with usable terms.

    The level payment is not rounded; ``round_payment=True`` rounds it to
    cents (521.65 for 55,000 at 7.875 % over 180 months).  Loans without
    usable terms have no payments: ``rejected_loans`` lists them.

    Interest is rounded to cents each month and the rounding feeds the next
    balance, so there is no closed form: the recurrence runs in NumPy inside
    each task, vectorised over the loans of an Arrow batch and sequential
    over months, and the rows go back to Spark as Arrow batches (no pandas).
    Spark partitions the loans; no loan crosses the driver.

    A loan yields one row per month of its term, so input splits sized by
    bytes would give tasks hundreds of times their input.  The (small)
    loan-terms frame is therefore first spread round-robin over
    ``TASKS_PER_SLOT`` tasks a slot; a task holds one block of rows at a
    time, however many it yields.  ``rows_per_task`` sizes the tasks by their
    output instead, at the price of one more pass over the terms; the only
    value read on the driver is then the total of the terms.
    """
    terms = loans.where(unusable_terms().isNull()).select(
        F.col("LOAN_ID").cast("string").alias("LOAN_ID"),
        F.col("ORIG_AMT").cast("double").alias("ORIG_AMT"),
        F.col("ORIG_RT").cast("double").alias("ORIG_RT"),
        F.col("ORIG_TRM").cast("long").alias("ORIG_TRM"),
    )
    slots, waves = parallelism(terms.sparkSession), TASKS_PER_SLOT
    if rows_per_task:
        total = terms.agg(F.sum("ORIG_TRM")).first()[0] or 0
        waves = max(1, -(-int(total) // (rows_per_task * slots)))
    terms = terms.repartition(waves * slots)  # whole waves: no idle tail
    return terms.mapInArrow(partial(_payment_batches, round_payment=round_payment), PAYMENT_SCHEMA)
