"""Look-back / look-ahead features over each loan's monthly history.

All eight columns share one window specification, so Catalyst plans a single
hash exchange on ``LOAN_ID``, one sort and one Window operator.  Frames count
rows (reported months), not calendar months.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, WindowSpec, functions as F

from .skew import global_positions, hot_keys, split_by_key

# Time order inside a loan: date, then age, then every other column that the
# windows and events read, so that rows which still tie are alike in all of
# them and the result depends on neither partitioning nor plan.
TIME_ORDER: tuple[str, ...] = (
    "ACT_DTE", "LOAN_AGE", "DLQ_STATUS", "ZB_CODE", "MOD_FLAG", "LAST_UPB", "ZB_DTE", "LPI_DTE", "FCC_DTE",
    "DISP_DTE", "DEFT_COST", "DEFT_PROCS",
)
LOAN_KEY = "LOAN_ID"

# --- fixed values: window horizons (rows) -----------------------------------
LOOK_BACK = 12
LOOK_AHEAD_SHORT = 12
LOOK_AHEAD_LONG = 24
# --- fixed values: names of the window columns ---------------------------------
WINDOW_COLUMNS = (
    "DLQ_LAG", "DLQ_LAGs12", "DLQ_NEXT12MAX", "DLQ_NEXT24MAX",
    "ZBCODE_NEXT12", "ZBCODE_NEXT24", "MOD_NEXT12", "MOD_NEXT24",
)
# --- end of fixed values ------------------------------------------------------


def order_of(df: DataFrame) -> tuple[str, ...]:
    """``TIME_ORDER`` as far as the frame has its columns (agencies differ)."""
    return tuple(c for c in TIME_ORDER if c in df.columns)


def loan_window(order: Sequence[str] = TIME_ORDER) -> WindowSpec:
    return Window.partitionBy(LOAN_KEY).orderBy(*order)


def window_columns(order: Sequence[str] = TIME_ORDER, w: WindowSpec | None = None) -> list:
    w = loan_window(order) if w is None else w
    back = w.rowsBetween(-LOOK_BACK, -1)
    ahead_s = w.rowsBetween(1, LOOK_AHEAD_SHORT)
    ahead_l = w.rowsBetween(1, LOOK_AHEAD_LONG)
    return [
        F.lag("DLQ_STATUS", 1).over(w).alias("DLQ_LAG"),
        F.collect_list("DLQ_STATUS").over(back).alias("DLQ_LAGs12"),
        F.max("DLQ_STATUS").over(ahead_s).alias("DLQ_NEXT12MAX"),
        F.max("DLQ_STATUS").over(ahead_l).alias("DLQ_NEXT24MAX"),
        F.max("ZB_CODE").over(ahead_s).alias("ZBCODE_NEXT12"),
        F.max("ZB_CODE").over(ahead_l).alias("ZBCODE_NEXT24"),
        F.max("MOD_FLAG").over(ahead_s).alias("MOD_NEXT12"),
        F.max("MOD_FLAG").over(ahead_l).alias("MOD_NEXT24"),
    ]


# A real loan reports at most one row a month (under 500 rows); a loan with
# more rows than this is treated as hot and split across tasks.
HOT_LOAN_ROWS = 1_000_000
# Rows per chunk of a hot loan (each chunk also carries 36 halo rows).
CHUNK_ROWS = 200_000


def hot_loans(perf: DataFrame, threshold: int = HOT_LOAN_ROWS) -> DataFrame:
    """Loans with more than ``threshold`` rows (partial aggregation: skew-safe)."""
    return hot_keys(perf, LOAN_KEY, threshold)


def split_windows(rows: DataFrame, order: Sequence[str] | None = None, chunk_rows: int = CHUNK_ROWS,
                  n_hot: int = 1) -> DataFrame:
    """W1-W8 for very long loans, computed chunk by chunk.

    Each loan is cut into chunks of ``chunk_rows`` consecutive rows; the last
    12 rows of a chunk are copied into the next chunk and the first 24 into
    the previous one, so every row's frames (12 back, 24 ahead) lie inside
    its own chunk's group.  Results are kept for each chunk's own rows only,
    so the output equals the per-loan window exactly.
    """
    if chunk_rows < max(LOOK_BACK, LOOK_AHEAD_LONG):
        raise ValueError("chunk_rows must cover the longest frame")
    cols = rows.columns
    order = order or order_of(rows)
    pos = global_positions(rows, LOAN_KEY, order, n_hot)
    chunk = F.floor(F.col("_pos") / F.lit(chunk_rows))
    off = F.col("_pos") - chunk * F.lit(chunk_rows)
    copies = F.array(
        F.struct(chunk.alias("c"), F.lit(True).alias("core")),
        F.when((off < LOOK_AHEAD_LONG) & (chunk > 0), F.struct((chunk - 1).alias("c"), F.lit(False).alias("core"))),
        F.when(off >= chunk_rows - LOOK_BACK, F.struct((chunk + 1).alias("c"), F.lit(False).alias("core"))),
    )
    spread = pos.select(
        "*", F.explode(F.filter(copies, lambda x: x.isNotNull())).alias("_copy")
    ).select(*cols, "_pos", F.col("_copy.c").alias("_chunk"), F.col("_copy.core").alias("_core"))
    w = Window.partitionBy(LOAN_KEY, "_chunk").orderBy("_pos")
    return (
        spread.select("*", *window_columns(order, w))
        .where(F.col("_core"))
        .drop("_pos", "_chunk", "_core")
    )


def enrich_panel(perf: DataFrame, order: Sequence[str] | None = None,
                 hot_threshold: int | None = HOT_LOAN_ROWS, chunk_rows: int = CHUNK_ROWS,
                 n_hot: int | None = None) -> DataFrame:
    """Append the eight window columns to a cleaned panel.

    Expects ``DLQ_STATUS`` already as an integer (see ``performance_base``).
    Columns that are never selected downstream are pruned by Catalyst.

    With ``hot_threshold`` set, loans holding more rows than that are found
    first (one count per loan, read back as a single number; pass ``n_hot``
    when it is known); when there are none the plan is the plain
    one-exchange window, otherwise those loans take the chunked path and
    the rest the plain one.
    """
    order = order or order_of(perf)
    plain = perf.select("*", *window_columns(order))
    if hot_threshold is None:
        return plain
    hot = hot_loans(perf, hot_threshold)
    if n_hot is None:
        n_hot = hot.count()
    if n_hot == 0:
        return plain
    cold, heavy = split_by_key(perf, hot, LOAN_KEY, n_hot)
    return cold.select("*", *window_columns(order)).unionByName(split_windows(heavy, order, chunk_rows, n_hot))
