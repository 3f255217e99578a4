"""Tape cleaning: date parsing, defaults, LTV fallback, keep-lists, status codes.

Each operator is one ``select`` so Catalyst sees a single projection and can
prune unused columns down to the scan.  Columns that are not part of the
declared schema (for example a vintage column) pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from ..functions.cleaning import dlq_status, ltv_fallback, parse_date, total, with_default
from ..schema import Agency, TapeSchema, agency as agency_of


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def _date_expr(df: DataFrame, tape: TapeSchema, name: str) -> Column:
    spec = tape[name]
    if _is_text(df, name):
        return parse_date(name, spec.pattern).alias(name)
    return F.col(name).cast(T.DateType()).alias(name)


def _typed(df: DataFrame, tape: TapeSchema, name: str) -> Column:
    spec = tape[name]
    if spec.dtype == "date":
        return _date_expr(df, tape, name)
    if df.schema[name].dataType != spec.spark_type:
        return F.col(name).try_cast(spec.spark_type).alias(name)
    return F.col(name)


def _extra(df: DataFrame, tape: TapeSchema) -> list[str]:
    return [c for c in df.columns if c not in tape]


def parse_dates(df: DataFrame, tape: TapeSchema) -> DataFrame:
    """Every date column by its pattern (text) or as a date (typed input)."""
    return df.select(*[_typed(df, tape, c) if c in tape and tape[c].dtype == "date" else F.col(c)
                       for c in df.columns])


def fill_defaults(df: DataFrame, tape: TapeSchema) -> DataFrame:
    """Null -> declared default on every non-date column that has one."""
    out = []
    for c in df.columns:
        if c in tape and tape[c].default is not None and tape[c].dtype != "date":
            out.append(with_default(_typed(df, tape, c), tape[c]).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def clean_acquisition(df: DataFrame, agency: str | Agency = "FNMA") -> DataFrame:
    """P1-P4 on a loan tape: dates, defaults, OCLTV fallback, drop flagged.

    Accepts the raw text scan (dates as text) or an already typed frame.
    """
    ag = agency if isinstance(agency, Agency) else agency_of(agency)
    tape = ag.acquisition
    exprs: dict[str, Column] = {}
    for spec in tape.columns:
        if not spec.keep or spec.name not in df.columns:
            continue
        e = _typed(df, tape, spec.name)
        if spec.default is not None and spec.dtype != "date":
            e = with_default(e, spec)
        exprs[spec.name] = e
    if "OCLTV" in exprs and "OLTV" in exprs:
        exprs["OCLTV"] = ltv_fallback(exprs["OCLTV"], exprs["OLTV"])
    cols = [e.alias(n) for n, e in exprs.items()]
    return df.select(*cols, *_extra(df, tape))


def performance_base(df: DataFrame, agency: str | Agency = "FNMA", nulls_as_zero: bool = False) -> DataFrame:
    """Enriched-path cleaning before the windows: P1, P6, P7, P8, all columns.

    The defaults of the performance tape are not applied here, as in the
    canonical Spark path.  Negative ages stay so that they count in windows.
    """
    ag = agency if isinstance(agency, Agency) else agency_of(agency)
    tape = ag.performance
    cols = []
    for c in df.columns:
        if c == "DLQ_STATUS":
            cols.append(dlq_status(c).alias(c))
        elif c in tape:
            cols.append(_typed(df, tape, c).alias(c))
        else:
            cols.append(F.col(c))
    present = set(df.columns)
    costs = [c for c in ag.cost_columns if c in present]
    procs = [c for c in ag.proceeds_columns if c in present]
    cost = total(costs, nulls_as_zero) if costs else F.lit(None).cast("double")
    proc = total(procs, nulls_as_zero) if procs else F.lit(None).cast("double")
    return df.select(*cols, cost.alias("DEFT_COST"), proc.alias("DEFT_PROCS"))


def clean_performance(df: DataFrame, agency: str | Agency = "FNMA") -> DataFrame:
    """Simple-path cleaning (P1, P5, P6, F1): keep-list columns, age >= 0.

    The default totals are not computed here: the keep-list would drop them.
    """
    ag = agency if isinstance(agency, Agency) else agency_of(agency)
    tape = ag.performance
    cols = []
    for c in tape.keep_names:
        if c == "DLQ_STATUS":
            cols.append(dlq_status(c).alias(c))
        else:
            cols.append(_typed(df, tape, c).alias(c))
    return df.select(*cols).where(F.col("LOAN_AGE") >= 0)


def staged_performance(df: DataFrame, agency: str | Agency = "FNMA") -> DataFrame:
    """Chunked-ingest cleaning: dates parsed, declared defaults filled, all columns."""
    ag = agency if isinstance(agency, Agency) else agency_of(agency)
    tape = ag.performance
    cols = []
    for c in df.columns:
        if c not in tape:
            cols.append(F.col(c))
            continue
        e = _typed(df, tape, c)
        if tape[c].default is not None and tape[c].dtype != "date":
            e = with_default(e, tape[c])
        cols.append(e.alias(c))
    return df.select(*cols)


def keep_columns(df: DataFrame, tape: TapeSchema) -> DataFrame:
    """P5: keep-list projection in schema order."""
    return df.select(*[c for c in tape.keep_names if c in df.columns])

