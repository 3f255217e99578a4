"""Column expressions for cleaning the tapes (all JVM-side, codegen friendly)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

from ..schema import ColumnSpec


def col_of(c: str | Column | int | float) -> Column:
    """Column name, Column, or a scalar (wrapped as a literal column)."""
    if isinstance(c, str):
        return F.col(c)
    if isinstance(c, (int, float)):
        return F.lit(c)
    return c


def parse_date(c: str | Column, pattern: str) -> Column:
    """Date text -> date by a Spark pattern; month patterns give day 1.

    Malformed text (``1/2000``, ``xx``, blank) gives null instead of failing
    the job under ANSI mode.
    """
    return F.try_to_date(col_of(c), pattern)


def with_default(c: str | Column, spec: ColumnSpec) -> Column:
    """Null -> the column's declared default, cast to the column type.

    Casting the literal keeps the column type (a bare ``-1`` would widen an
    integer column compared with a double literal).
    """
    return F.coalesce(col_of(c), F.lit(spec.default).cast(spec.spark_type))


def ltv_fallback(ocltv: str | Column = "OCLTV", oltv: str | Column = "OLTV") -> Column:
    """Combined LTV of 0 falls back to the plain LTV (runs after defaults)."""
    ocltv, oltv = col_of(ocltv), col_of(oltv)
    return F.when(ocltv == 0, oltv).otherwise(ocltv)


# --- fixed values: delinquency status codes ---------------------------------
DLQ_UNKNOWN = -1   # status missing
DLQ_REO = -2       # status text "X"
DLQ_REO_TEXT = "X"
# --- end of fixed values ------------------------------------------------------


def dlq_status(c: str | Column = "DLQ_STATUS") -> Column:
    """Delinquency text -> int: null -> -1, ``X`` -> -2, else the integer.

    Text that is neither gives null rather than an ANSI cast failure.
    """
    c = col_of(c)
    return (
        F.when(c.isNull(), F.lit(DLQ_UNKNOWN))
        .when(c == DLQ_REO_TEXT, F.lit(DLQ_REO))
        .otherwise(c.try_cast(T.IntegerType()))
    )


def total(columns: Iterable[str | Column], nulls_as_zero: bool = False) -> Column:
    """Sum of the parts; null when any part is null unless ``nulls_as_zero``."""
    parts = [col_of(c) for c in columns]
    if nulls_as_zero:
        parts = [F.coalesce(p, F.lit(0.0)) for p in parts]
    out = parts[0]
    for p in parts[1:]:
        out = out + p
    return out


def channel_bucket(c: str | Column = "ORIG_CHN") -> Column:
    """Origination channel bucket: R and C -> R1, B -> B1, else unchanged."""
    c = col_of(c)
    return F.when(c.isin("R", "C"), F.lit("R1")).when(c == "B", F.lit("B1")).otherwise(c)


def monthly_rate(c: str | Column = "ORIG_RT") -> Column:
    """Annual percentage rate -> monthly decimal rate."""
    return col_of(c) / F.lit(1200.0)


def round_half_up(c: str | Column, places: int) -> Column:
    """Half-up rounding on the binary value: floor(x * 10^p + 0.5) / 10^p.

    Written with plain IEEE operations so that Spark, NumPy and SQL engines
    round the same double to the same result.
    """
    scale = float(10 ** places)
    return F.floor(col_of(c) * F.lit(scale) + F.lit(0.5)).cast(T.DoubleType()) / F.lit(scale)
