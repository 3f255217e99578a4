"""Amortization as column expressions.

Write r for the monthly rate, n for the term, P for the principal and
B(t) for the balance after t level payments.  The balance recurrence
B(t) = B(t-1) - (A - B(t-1) * r) has the closed form
B(t) = P (1+r)^t - A ((1+r)^t - 1) / r, so every (loan, month) cell is an
independent expression: no row depends on another and nothing is collected.
A zero rate gives the straight line P (1 - t / n).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .cleaning import col_of

# --- fixed values: schedule mask --------------------------------------------
BEYOND_TERM = -999.0  # balance reported for months past the term
# --- end of fixed values ------------------------------------------------------


def growth(r: Column, t: Column) -> Column:
    return F.pow(F.lit(1.0) + r, t)


def level_payment(principal, rate, term) -> Column:
    """A = P r / (1 - (1+r)^-n); P / n when the rate is zero; null for a term below one."""
    p, r, n = col_of(principal), col_of(rate), col_of(term)
    level = p * F.try_divide(r, F.lit(1.0) - F.pow(F.lit(1.0) + r, -n))
    return F.when(n > 0, F.when(r == 0, F.try_divide(p, n)).otherwise(level))


def balance(principal, rate, term, t) -> Column:
    """Unmasked scheduled balance after t payments (keeps going past n)."""
    p, r, n, t = col_of(principal), col_of(rate), col_of(term), col_of(t)
    a = level_payment(p, r, n)
    g = growth(r, t)
    return F.when(r == 0, p - a * t).otherwise(p * g - F.try_divide(a * (g - F.lit(1.0)), r))


def balance_after(principal, rate, payment, t, grown: Column | None = None) -> Column:
    """Balance after t payments of a given size, level or not (it may grow).

    ``grown`` is the growth of t months where the caller has it already.
    """
    p, r, a, t = col_of(principal), col_of(rate), col_of(payment), col_of(t)
    g = growth(r, t) if grown is None else grown
    return F.when(r == 0, p - a * t).otherwise(p * g - F.try_divide(a * (g - F.lit(1.0)), r))


def balance_by_principal_parts(principal, rate, term, t) -> Column:
    """P less the principal parts of payments 1..t (the ``ppmt`` form).

    The principal part of payment i is (A - P r)(1+r)^(i-1); summed, the
    balance is P - (A - P r)((1+r)^t - 1) / r.  Not masked past the term.
    """
    p, r, n, t = col_of(principal), col_of(rate), col_of(term), col_of(t)
    a = level_payment(p, r, n)
    g = growth(r, t)
    return F.when(r == 0, p - a * t).otherwise(p - F.try_divide((a - p * r) * (g - F.lit(1.0)), r))


def masked_balance(principal, rate, term, t) -> Column:
    """Scheduled balance with the term mask: B(t) before n, 0 at n, -999 after.

    Null when the term is unknown (for example a loan missing from the tape)
    or below one month.
    """
    n, t = col_of(term), col_of(t)
    return F.when(n > 0, (
        F.when(t < n, balance(principal, rate, term, t))
        .when(t == n, F.lit(0.0))
        .when(t > n, F.lit(BEYOND_TERM))
    ))
