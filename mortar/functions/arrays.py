"""Array column helpers for the look-back arrays."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .cleaning import col_of

PAD_VALUE = -1


def fill_empty(c) -> Column:
    """Null array -> empty array of the same element type."""
    c = col_of(c)
    return F.coalesce(c, F.array_repeat(F.lit(PAD_VALUE), 0).cast("array<int>"))


def orig_size(c) -> Column:
    """Length of the array, 0 for null."""
    return F.size(fill_empty(c))


def left_pad(c, size: int = 12, value: int = PAD_VALUE) -> Column:
    """Left-pad with ``value`` up to ``size`` elements; longer arrays unchanged."""
    c = fill_empty(c)
    missing = F.greatest(F.lit(0), F.lit(size) - F.size(c))
    return F.concat(F.array_repeat(F.lit(value), missing), c)


def element(c, i: int) -> Column:
    """0-based element i, null when the array is shorter."""
    return F.try_element_at(col_of(c), F.lit(i + 1))


def as_text(c, sep: str = ",") -> Column:
    """Array rendered as separated text; null and empty arrays give ''."""
    return F.coalesce(F.array_join(col_of(c), sep), F.lit(""))
