"""Calendar months as numbers, and small expression helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from .cleaning import col_of


def month_number(d) -> Column:
    """Months since year 0: consecutive months differ by one."""
    return F.year(col_of(d)) * 12 + F.month(col_of(d)) - 1


def month_date(number) -> Column:
    """First day of a month number."""
    n = col_of(number)
    return F.make_date(F.floor(n / 12).cast("int"), (F.pmod(n, F.lit(12)) + 1).cast("int"), F.lit(1))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once (a lambda over one element)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """As ``let``, for use inside lambdas: the end of a fold over nothing.

    ``let`` builds two arrays, copies what the body returns and works out its
    type once more at every call.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda v, _: v, body)


def finite(c) -> Column:
    """True for a number that is neither null, NaN nor infinite."""
    c = col_of(c)
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
