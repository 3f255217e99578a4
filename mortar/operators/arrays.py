"""Array features: sizes, padding and expansion into numbered columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.arrays import element, fill_empty, left_pad, orig_size


def fill_and_size(df: DataFrame, column: str) -> DataFrame:
    """A1/A2: null array -> empty, plus ``<column>_OrigSize``."""
    return df.select(
        *[c for c in df.columns if c != column],
        fill_empty(column).alias(column),
        orig_size(column).alias(f"{column}_OrigSize"),
    )


def pad_array(df: DataFrame, column: str, size: int = 12) -> DataFrame:
    """A3: left-pad the array with -1 to ``size`` (longer arrays unchanged)."""
    return df.withColumn(column, left_pad(column, size))


def expand_array(df: DataFrame, column: str, size: int = 12) -> DataFrame:
    """A4: size column, padded array and one column per element, in place.

    The elements are projected from the row's own array, so no join back on
    the loan key is needed and ``size`` is honoured.
    """
    padded = left_pad(column, size)
    return df.select(
        "*",
        orig_size(column).alias(f"{column}_OrigSize"),
        *[element(padded, i).alias(f"{column}_{i}") for i in range(size)],
    )
