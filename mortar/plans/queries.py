"""Registered queries: one per operator group, each with its DuckDB oracle.

Every query reads the driver tables under ``sf_dir`` (through the fixture
tapes derived from them) and runs over all rows.  Array columns are
presented as comma-joined text so both engines compare them the same way.
Queries that exercise a sink write below the session's checkpoint root and
return the frame read back from what was written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..functions.arrays import as_text
from ..functions.cleaning import channel_bucket, dlq_status, monthly_rate, round_half_up
from ..operators import arrays as arr
from ..operators.clean import (
    clean_acquisition, clean_performance, fill_defaults, keep_columns, parse_dates, staged_performance,
)
from ..operators.events import first_modification, first_serious_delinquency, zero_balance_events
from ..operators.outcome import loan_with, max_age
from ..operators.schedule import (
    payment_table, scheduled_balance_at_age, schedule_long, schedule_ppmt, schedule_unmasked,
    schedule_wide, with_level_payment,
)
from ..operators.panel import WINDOW_COLUMNS, enrich_panel
from ..operators.skew import row_places
from ..schema import FNMA, FRED
from ..session import parallelism, scratch_path
from ..sinks.parquet import save_bucketed, save_parquet, save_table, save_vintage, stage_to_vintage
from ..sinks.versions import read_versions
from ..sources.fixtures import fnma_acquisition, fnma_performance, fred_acquisition, fred_performance
from ..sources.text import read_acquisition, read_performance, read_tape, write_tape
from ..streaming.ingest import ingest_incremental, read_staged
from ..streaming.restate import ingest_versions
from . import oracle as O
from .loan_level import build, save

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Vintage used where the reference reads one quarter's files.
VINTAGE = "2000Q1"
NEXT_VINTAGE = "2000Q2"
MONTH_COUNT = 12


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = O.with_ctes(sql)
        return fn
    return deco


def present(df: DataFrame) -> DataFrame:
    """Arrays as comma-joined text for engine-neutral comparison."""
    return df.select(*[
        as_text(f.name).alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
        for f in df.schema.fields
    ])


def _loans(spark, sf) -> DataFrame:
    return clean_acquisition(fnma_acquisition(spark, sf), FNMA)


def _level(spark, sf):
    return build(fnma_performance(spark, sf), fnma_acquisition(spark, sf), FNMA, MONTH_COUNT)


def _text_tape(spark, sf, kind: str) -> str:
    path = scratch_path(spark, f"{kind}-text")
    if kind == "acquisition":
        write_tape(fnma_acquisition(spark, sf), path, FNMA.acquisition)
    else:
        write_tape(fnma_performance(spark, sf), path, FNMA.performance)
    return path


# --- sources and sinks -------------------------------------------------------

_LOANS_NO_ACQ = ", ".join(O.LOAN_KEEP)


@register("scan_acquisition", f"SELECT {_LOANS_NO_ACQ} FROM loans")
def scan_acquisition(spark, sf):
    return read_acquisition(spark, _text_tape(spark, sf, "acquisition"), FNMA)


_PERF_KEEP_SQL = ", ".join(O.PERF_KEEP)


@register("scan_performance", f"SELECT {_PERF_KEEP_SQL} FROM perf WHERE LOAN_AGE >= 0")
def scan_performance(spark, sf):
    return read_performance(spark, _text_tape(spark, sf, "performance"), FNMA)


_STAGED_SQL = O.filled(O.PERF_ALL, O.PERF_DEFAULTS)


@register("ingest_incremental", f"SELECT {_STAGED_SQL} FROM perf_raw")
def ingest_incremental_q(spark, sf):
    landing = _text_tape(spark, sf, "performance")
    target = scratch_path(spark, "staged")
    ingest_incremental(spark, landing, target, scratch_path(spark, "ingest-ckpt"), FNMA)
    return read_staged(spark, target)


@register("ingest_two_quarters", f"SELECT {_STAGED_SQL}, '2000Q1' AS ACQ FROM perf_raw UNION ALL "
                                 f"SELECT {_STAGED_SQL}, '2000Q2' AS ACQ FROM perf_raw")
def ingest_two_quarters_q(spark, sf):
    """The monthly tape landed twice, as two quarters with a landing folder and a checkpoint each."""
    target = scratch_path(spark, "staged")
    for vintage in (VINTAGE, NEXT_VINTAGE):
        landing, ckpt = _text_tape(spark, sf, "performance"), scratch_path(spark, "ingest-ckpt")
        ingest_incremental(spark, landing, target, ckpt, FNMA, vintage=vintage)
        ingest_incremental(spark, landing, target, ckpt, FNMA, vintage=vintage)  # finds nothing new
    return read_staged(spark, target)


@register("ingest_replace", f"SELECT {_STAGED_SQL}, '2000Q2' AS ACQ FROM perf_raw")
def ingest_replace_q(spark, sf):
    """A quarter that takes the place of all that was landed, by one commit."""
    target = scratch_path(spark, "versions")
    for vintage, mode in ((VINTAGE, "append"), (NEXT_VINTAGE, "replace")):
        landing, ckpt = _text_tape(spark, sf, "performance"), scratch_path(spark, "ingest-ckpt")
        ingest_versions(spark, landing, target, ckpt, FNMA, mode, vintage)
        ingest_versions(spark, landing, target, ckpt, FNMA, mode, vintage)  # finds nothing new
    return read_versions(spark, target)


# The first quarter of 2001 restated: other balances for the months the loans already have.
_RESTATED = "ACT_DTE BETWEEN DATE '2001-01-01' AND DATE '2001-03-31'"


@register("ingest_restated", f"SELECT {_STAGED_SQL} FROM (SELECT * REPLACE (CASE WHEN {_RESTATED} THEN LAST_UPB + 100 "
                             "ELSE LAST_UPB END AS LAST_UPB) FROM perf_raw)")
def ingest_restated_q(spark, sf):
    """A restated quarter replaces the rows of its own loans and months."""
    target, again = scratch_path(spark, "versions"), scratch_path(spark, "restated-text")
    ingest_versions(spark, _text_tape(spark, sf, "performance"), target, scratch_path(spark, "ingest-ckpt"), FNMA)
    restated = fnma_performance(spark, sf).where(_RESTATED).withColumn("LAST_UPB", F.col("LAST_UPB") + 100)
    write_tape(restated, again, FNMA.performance)
    ingest_versions(spark, again, target, scratch_path(spark, "ingest-ckpt"), FNMA, "upsert")
    return read_versions(spark, target)


@register("stage_to_vintage", f"SELECT {_STAGED_SQL}, '2000Q1' AS ACQ FROM perf_raw")
def stage_to_vintage_q(spark, sf):
    staged = scratch_path(spark, "staged")
    save_parquet(staged_performance(fnma_performance(spark, sf), FNMA), staged)
    out = scratch_path(spark, "perf-vintage")
    stage_to_vintage(spark.read.parquet(staged), VINTAGE, out)
    return spark.read.parquet(out)


_LOANS_SQL = ", ".join(O.LOAN_COLS)


@register("write_parquet", f"SELECT {_LOANS_SQL} FROM loans")
def write_parquet_q(spark, sf):
    path = save_parquet(_loans(spark, sf), scratch_path(spark, "loans"))
    return spark.read.parquet(path)


@register("write_vintage", f"SELECT {_LOANS_SQL} FROM loans")
def write_vintage_q(spark, sf):
    folder = scratch_path(spark, "result")
    loans = _loans(spark, sf)
    path = save_vintage(loans, folder, "FNMA", "Loan")
    # Rewriting one vintage replaces that folder only.
    save_vintage(loans.where(F.col("ACQ") == VINTAGE), folder, "FNMA", "Loan")
    return spark.read.parquet(path)


@register("catalog_table", f"SELECT {_LOANS_SQL} FROM loans")
def catalog_table_q(spark, sf):
    path = scratch_path(spark, "table")
    table = "loans_" + path.rsplit("-", 1)[-1]
    name = save_table(spark, _loans(spark, sf), "mortar_db", table, path=path)
    return spark.table(name)


_CHN_SQL = "case when ORIG_CHN in ('R', 'C') then 'R1' when ORIG_CHN = 'B' then 'B1' else ORIG_CHN end"


@register("rewrite_vintage_empty", f"SELECT {_LOANS_SQL} FROM loans WHERE ACQ <> '2000Q1'")
def rewrite_vintage_empty_q(spark, sf):
    """A vintage rewritten with no rows is empty afterwards; the others stay."""
    folder = scratch_path(spark, "result")
    loans = _loans(spark, sf)
    save_vintage(loans, folder, "FNMA", "Loan")
    return spark.read.parquet(save_vintage(loans.where("false"), folder, "FNMA", "Loan", VINTAGE))


# Loans and their largest amount per channel bucket and vintage.
@register("sql_view", """
SELECT b.bucket AS CHN_BUCKET, l.ACQ, count(*) AS N_LOANS, max(l.ORIG_AMT) AS MAX_AMT, min(l.OCLTV) AS MIN_LTV
FROM loans l JOIN (VALUES ('R', 'R1'), ('C', 'R1'), ('B', 'B1')) b(channel, bucket) ON b.channel = l.ORIG_CHN
GROUP BY b.bucket, l.ACQ HAVING count(*) > 1
""")
def sql_view_q(spark, sf):
    view = "acq_" + scratch_path(spark, "view").rsplit("-", 1)[-1]
    loans = _loans(spark, sf)
    loans.withColumn("CHN_BUCKET", channel_bucket("ORIG_CHN")).createOrReplaceTempView(view)
    return spark.sql(
        f"SELECT CHN_BUCKET, ACQ, count(1) AS N_LOANS, max(ORIG_AMT) AS MAX_AMT, min(OCLTV) AS MIN_LTV "
        f"FROM {view} GROUP BY CHN_BUCKET, ACQ HAVING count(1) > 1")


# --- cleaning ----------------------------------------------------------------

_DATES = ["ACT_DTE", "Maturity_Date", "ZB_DTE", "LPI_DTE", "FCC_DTE", "DISP_DTE"]


@register("date_parse", f"SELECT LOAN_ID, LOAN_AGE, {', '.join(_DATES)} FROM perf_raw")
def date_parse_q(spark, sf):
    raw = read_tape(spark, _text_tape(spark, sf, "performance"), FNMA.performance)
    return parse_dates(raw, FNMA.performance).select("LOAN_ID", "LOAN_AGE", *_DATES)


_DEFAULTED = [c.name for c in FNMA.acquisition.defaulted]


@register("default_fill", f"SELECT LOAN_ID, {O.filled(list(O.LOAN_DEFAULTS), O.LOAN_DEFAULTS)} FROM acq_raw")
def default_fill_q(spark, sf):
    return fill_defaults(fnma_acquisition(spark, sf), FNMA.acquisition).select("LOAN_ID", *_DEFAULTED)


@register("ltv_fallback", "SELECT LOAN_ID, OLTV, OCLTV FROM loans")
def ltv_fallback_q(spark, sf):
    return _loans(spark, sf).select("LOAN_ID", "OLTV", "OCLTV")


@register("loan_clean", f"SELECT {_LOANS_SQL} FROM loans")
def loan_clean_q(spark, sf):
    return _loans(spark, sf)


@register("dlq_status", f"SELECT LOAN_ID, ACT_DTE, DLQ_STATUS AS DLQ_TEXT, {O.DLQ_SQL} AS DLQ_STATUS FROM perf_raw")
def dlq_status_q(spark, sf):
    raw = fnma_performance(spark, sf)
    return raw.select("LOAN_ID", "ACT_DTE", F.col("DLQ_STATUS").alias("DLQ_TEXT"),
                      dlq_status("DLQ_STATUS").alias("DLQ_STATUS"))


@register("default_totals", "SELECT LOAN_ID, ACT_DTE, DEFT_COST, DEFT_PROCS FROM perf")
def default_totals_q(spark, sf):
    return _level(spark, sf).perf_base.select("LOAN_ID", "ACT_DTE", "DEFT_COST", "DEFT_PROCS")


@register("panel_clean", f"SELECT {_PERF_KEEP_SQL} FROM perf WHERE LOAN_AGE >= 0")
def panel_clean_q(spark, sf):
    return clean_performance(fnma_performance(spark, sf), FNMA)


@register("channel_bucket", f"SELECT LOAN_ID, ORIG_CHN, {_CHN_SQL} AS CHN_BUCKET FROM loans")
def channel_bucket_q(spark, sf):
    return _loans(spark, sf).select("LOAN_ID", "ORIG_CHN", channel_bucket("ORIG_CHN").alias("CHN_BUCKET"))


@register("monthly_rate", "SELECT LOAN_ID, ORIG_RT, ORIG_RT / 1200.0 AS MONTHLY_RT FROM loans")
def monthly_rate_q(spark, sf):
    return _loans(spark, sf).select("LOAN_ID", "ORIG_RT", monthly_rate("ORIG_RT").alias("MONTHLY_RT"))


@register("negative_age_audit",
          "SELECT LOAN_ID, ACT_DTE, LOAN_AGE, LAST_UPB, CAST(NULL AS DOUBLE) AS SCHD_UPB, DLQ_STATUS "
          "FROM perf WHERE LOAN_AGE < 0")
def negative_age_audit_q(spark, sf):
    lvl = _level(spark, sf)
    panel = keep_columns(lvl.perf_base, FNMA.performance)
    return (
        scheduled_balance_at_age(panel, lvl.loans, MONTH_COUNT)
        .where(F.col("LOAN_AGE") < 0)
        .select("LOAN_ID", "ACT_DTE", "LOAN_AGE", "LAST_UPB", "SCHD_UPB", "DLQ_STATUS")
    )


# --- windows -----------------------------------------------------------------

def _window_query(column: str):
    def q(spark, sf):
        return present(_level(spark, sf).panel.select("LOAN_ID", "ACT_DTE", "LOAN_AGE", column))
    return q


for _key, _col in [
    ("win_dlq_lag", "DLQ_LAG"), ("win_dlq_prev12", "DLQ_LAGs12"),
    ("win_dlq_next12", "DLQ_NEXT12MAX"), ("win_dlq_next24", "DLQ_NEXT24MAX"),
    ("win_zb_next12", "ZBCODE_NEXT12"), ("win_zb_next24", "ZBCODE_NEXT24"),
    ("win_mod_next12", "MOD_NEXT12"), ("win_mod_next24", "MOD_NEXT24"),
]:
    register(_key, f"SELECT LOAN_ID, ACT_DTE, LOAN_AGE, {O.cols([_col])} FROM panel")(_window_query(_col))


@register("panel_windows", "SELECT LOAN_ID, ACT_DTE, LOAN_AGE, " + O.cols(
    ["DLQ_LAG", "DLQ_LAGs12", "DLQ_NEXT12MAX", "DLQ_NEXT24MAX", "ZBCODE_NEXT12", "ZBCODE_NEXT24",
     "MOD_NEXT12", "MOD_NEXT24"]) + " FROM panel")
def panel_windows_q(spark, sf):
    return present(_level(spark, sf).panel.select("LOAN_ID", "ACT_DTE", "LOAN_AGE", *WINDOW_COLUMNS))


@register("bucketed_panel", "SELECT LOAN_ID, ACT_DTE, LOAN_AGE, " + O.cols(
    ["DLQ_LAG", "DLQ_LAGs12", "DLQ_NEXT12MAX", "DLQ_NEXT24MAX", "ZBCODE_NEXT12", "ZBCODE_NEXT24",
     "MOD_NEXT12", "MOD_NEXT24"]) + " FROM panel")
def bucketed_panel_q(spark, sf):
    """W1-W8 read from a table bucketed by LOAN_ID: the window needs no exchange."""
    path = scratch_path(spark, "bucketed")
    name = save_bucketed(spark, _level(spark, sf).perf_base, "mortar_db", "perf_" + path.rsplit("-", 1)[-1],
                         parallelism(spark), "LOAN_ID", ["ACT_DTE", "LOAN_AGE"], path=path)
    panel = enrich_panel(spark.table(name))
    return present(panel.select("LOAN_ID", "ACT_DTE", "LOAN_AGE", *WINDOW_COLUMNS))


# The hot-loan path on the whole tables: with a 60-row threshold about half of
# the loans (45-99 months each) count as hot and are windowed in 25-row
# chunks with halos; the results must equal the plain per-loan window.
SPLIT_THRESHOLD, SPLIT_CHUNK = 60, 25


def _split_level(spark, sf):
    return build(fnma_performance(spark, sf), fnma_acquisition(spark, sf), FNMA, MONTH_COUNT,
                 hot_threshold=SPLIT_THRESHOLD, chunk_rows=SPLIT_CHUNK)


@register("panel_windows_split", "SELECT LOAN_ID, ACT_DTE, LOAN_AGE, " + O.cols(
    ["DLQ_LAG", "DLQ_LAGs12", "DLQ_NEXT12MAX", "DLQ_NEXT24MAX", "ZBCODE_NEXT12", "ZBCODE_NEXT24",
     "MOD_NEXT12", "MOD_NEXT24"]) + " FROM panel")
def panel_windows_split_q(spark, sf):
    return present(_split_level(spark, sf).panel.select("LOAN_ID", "ACT_DTE", "LOAN_AGE", *WINDOW_COLUMNS))


# --- events ------------------------------------------------------------------

@register("first_mod", f"SELECT {O.cols(O.MOD_COLS)} FROM modf")
def first_mod_q(spark, sf):
    return present(first_modification(_level(spark, sf).panel))


@register("first_90d", f"SELECT {O.cols(O.F3Q_COLS)} FROM f3q")
def first_90d_q(spark, sf):
    return present(first_serious_delinquency(_level(spark, sf).panel))


@register("zero_balance", f"SELECT {O.cols(O.ZB_COLS)} FROM zb")
def zero_balance_q(spark, sf):
    return present(zero_balance_events(_level(spark, sf).panel))


def _expanded_sql(source: str, column: str, size: int = 12, extra: str = "") -> str:
    """Padded array and its elements, as the A3/A4 oracle."""
    n = f"CAST(coalesce(len({column}), 0) AS INTEGER)"
    padded = (f"list_concat(list_transform(range(greatest(0, {size} - {n})), lambda x: -1), "
              f"coalesce({column}, []::INTEGER[]))")
    elems = ", ".join(f"padded[{i + 1}] AS {column}_{i}" for i in range(size))
    return (f"SELECT LOAN_ID{extra}, {column}_OrigSize, {elems} FROM "
            f"(SELECT *, {n} AS {column}_OrigSize, {padded} AS padded FROM {source})")


@register("early_delinquency", _expanded_sql("(SELECT * FROM f3q WHERE F3Q_AGE < 12)", "F3Q_DLQ_LAGs12",
                                             extra=", F3Q_DTE, F3Q_AGE"))
def early_delinquency_q(spark, sf):
    f3q = first_serious_delinquency(_level(spark, sf).panel).where(F.col("F3Q_AGE") < 12)
    out = arr.expand_array(f3q, "F3Q_DLQ_LAGs12", 12)
    return out.select("LOAN_ID", "F3Q_DTE", "F3Q_AGE", "F3Q_DLQ_LAGs12_OrigSize",
                      *[f"F3Q_DLQ_LAGs12_{i}" for i in range(12)])


# W9, W10 and F5 as row numbers: first row of each loan, filtered after numbering.
@register("first_mod_rn", f"SELECT {O.cols(O.MOD_COLS)} FROM modf")
def first_mod_rn_q(spark, sf):
    return present(first_modification(_level(spark, sf).panel, method="row_number"))


@register("first_90d_rn", f"SELECT {O.cols(O.F3Q_COLS)} FROM f3q")
def first_90d_rn_q(spark, sf):
    return present(first_serious_delinquency(_level(spark, sf).panel, method="row_number"))


# Every month reported twice, the second time with another balance.
_TWICE = ("(SELECT * FROM perf UNION ALL SELECT * REPLACE (LAST_UPB + 1 AS LAST_UPB, 'Y' AS MOD_FLAG) FROM perf)")
_TWICE_SQL = (f"SELECT LOAN_ID, ACT_DTE, LOAN_AGE, LAST_UPB, {O.cols(list(WINDOW_COLUMNS))} "
              f"FROM (SELECT *, {O.panel_windows(O.TOTAL_ORDER)} FROM {_TWICE})")


def _twice(spark, sf, **how) -> DataFrame:
    perf = _level(spark, sf).perf_base
    again = perf.withColumn("LAST_UPB", F.col("LAST_UPB") + 1).withColumn("MOD_FLAG", F.lit("Y"))
    panel = enrich_panel(perf.unionByName(again), **how)
    return present(panel.select("LOAN_ID", "ACT_DTE", "LOAN_AGE", "LAST_UPB", *WINDOW_COLUMNS))


register("panel_windows_twice", _TWICE_SQL)(lambda spark, sf: _twice(spark, sf))
register("panel_windows_twice_split", _TWICE_SQL)(
    lambda spark, sf: _twice(spark, sf, hot_threshold=2 * SPLIT_THRESHOLD, chunk_rows=SPLIT_CHUNK))


# --- joins and sets ----------------------------------------------------------

def _join_sql(event_cte: str, event_cols: list[str]) -> str:
    return (f"SELECT {O.cols(O.LOAN_COLS, 'l.')}, {O.cols(event_cols[1:], 'e.')} "
            f"FROM loans l LEFT JOIN {event_cte} e ON l.LOAN_ID = e.LOAN_ID")


@register("loan_mod", _join_sql("modf", O.MOD_COLS))
def loan_mod_q(spark, sf):
    lvl = _level(spark, sf)
    return present(loan_with(lvl.loans, lvl.first_mod))


@register("loan_90d", _join_sql("f3q", O.F3Q_COLS))
def loan_90d_q(spark, sf):
    lvl = _level(spark, sf)
    return present(loan_with(lvl.loans, lvl.first_90d))


@register("loan_zb", _join_sql("zb", O.ZB_COLS))
def loan_zb_q(spark, sf):
    lvl = _level(spark, sf)
    return present(loan_with(lvl.loans, lvl.zero_balance))


_OUTCOME_EVENTS = (f"{O.cols(O.MOD_COLS[1:], 'm.')}, {O.cols(O.F3Q_COLS[1:], 'f.')}, "
                   f"{O.cols(O.ZB_COLS[1:], 'z.')}")


ORACLE_SELECT_OUTCOME = (
    f"SELECT {O.cols(O.LOAN_COLS, 'l.')}, {_OUTCOME_EVENTS} FROM loans l "
    "LEFT JOIN modf m ON l.LOAN_ID = m.LOAN_ID LEFT JOIN f3q f ON l.LOAN_ID = f.LOAN_ID "
    "LEFT JOIN zb z ON l.LOAN_ID = z.LOAN_ID ORDER BY l.LOAN_ID")


@register("loan_outcome", ORACLE_SELECT_OUTCOME)
def loan_outcome_q(spark, sf):
    return present(_level(spark, sf).outcome(ordered=True))


# O1: place of every row in the ordered outcome (rows of one loan are alike here).
@register("loan_outcome_order",
          "SELECT row_number() OVER (ORDER BY l.LOAN_ID) - 1 AS POS, l.LOAN_ID FROM loans l "
          "LEFT JOIN zb z ON l.LOAN_ID = z.LOAN_ID")
def loan_outcome_order_q(spark, sf):
    return row_places(_level(spark, sf).outcome(ordered=True)).select("POS", "LOAN_ID")


_UNIVERSE = ("(SELECT LOAN_ID FROM modf UNION SELECT LOAN_ID FROM f3q UNION SELECT LOAN_ID FROM zb)")


register("loan_outcome_split", ORACLE_SELECT_OUTCOME)(
    lambda spark, sf: present(_split_level(spark, sf).outcome(ordered=True)))

register("loan_outcome_joins", ORACLE_SELECT_OUTCOME)(
    lambda spark, sf: present(_level(spark, sf).outcome_by_joins(ordered=True)))


@register("event_universe", f"SELECT LOAN_ID FROM {_UNIVERSE}")
def event_universe_q(spark, sf):
    return _level(spark, sf).universe


_UNIVERSE_OUTCOME = (f"SELECT u.LOAN_ID, {_OUTCOME_EVENTS} FROM {_UNIVERSE} u "
                     "LEFT JOIN modf m ON u.LOAN_ID = m.LOAN_ID LEFT JOIN f3q f ON u.LOAN_ID = f.LOAN_ID "
                     "LEFT JOIN zb z ON u.LOAN_ID = z.LOAN_ID")


@register("universe_outcome", _UNIVERSE_OUTCOME)
def universe_outcome_q(spark, sf):
    # No loan tape loaded: the outcome is the event universe with its events.
    return present(build(fnma_performance(spark, sf), None, FNMA, MONTH_COUNT).outcome())


register("universe_outcome_joins", _UNIVERSE_OUTCOME)(
    lambda spark, sf: present(build(fnma_performance(spark, sf), None, FNMA, MONTH_COUNT).outcome_by_joins()))


# P10: -999 (past the term) fills nothing.
_FILL_SQL = (f"CASE WHEN {O.masked_cell_sql('p.LOAN_AGE', 0)} = -999.0 THEN NULL "
             f"ELSE round({O.masked_cell_sql('p.LOAN_AGE', 0)}, 3) + 0.0 END")
_PWS_COLS = ", ".join(
    f"coalesce(p.LAST_UPB, {_FILL_SQL}) AS LAST_UPB"
    if c == "LAST_UPB" else f"p.{c}" for c in O.PERF_KEEP
)


@register("panel_with_schedule",
          f"SELECT {_PWS_COLS} FROM perf p LEFT JOIN "
          f"(SELECT *, {O.month_count_sql(MONTH_COUNT)} AS N FROM pay) s "
          "ON p.LOAN_ID = s.LOAN_ID AND p.LOAN_AGE < s.N WHERE p.LOAN_AGE >= 0 ORDER BY p.LOAN_ID, p.ACT_DTE")
def panel_with_schedule_q(spark, sf):
    return _level(spark, sf).performance(ordered=True)


# O2: place of every row in the ordered panel.
@register("panel_order",
          "SELECT row_number() OVER (ORDER BY LOAN_ID, ACT_DTE) - 1 AS POS, LOAN_ID, ACT_DTE FROM perf "
          "WHERE LOAN_AGE >= 0")
def panel_order_q(spark, sf):
    return row_places(_level(spark, sf).performance(ordered=True)).select("POS", "LOAN_ID", "ACT_DTE")


# The fill over the whole term instead of the published twelve months.
@register("panel_with_schedule_whole_term",
          f"SELECT {_PWS_COLS} FROM perf p LEFT JOIN (SELECT *, {O.month_count_sql(None)} AS N FROM pay) s "
          "ON p.LOAN_ID = s.LOAN_ID AND p.LOAN_AGE < s.N WHERE p.LOAN_AGE >= 0")
def panel_with_schedule_whole_term_q(spark, sf):
    return build(fnma_performance(spark, sf), fnma_acquisition(spark, sf), FNMA, None).performance()


@register("write_vintage_performance",
          f"SELECT {_PWS_COLS}, '2000Q1' AS ACQ FROM perf p LEFT JOIN "
          f"(SELECT *, {O.month_count_sql(MONTH_COUNT)} AS N FROM pay) s "
          "ON p.LOAN_ID = s.LOAN_ID AND p.LOAN_AGE < s.N WHERE p.LOAN_AGE >= 0")
def write_vintage_performance_q(spark, sf):
    """S8 for a whole build; the saved monthly half is read back."""
    return spark.read.parquet(save(_level(spark, sf), scratch_path(spark, "result"), VINTAGE)["LoanPerformance"])


# --- rows that cannot be used ---------------------------------------------------

# The tapes with some loan ids, amounts, rates and terms spoilt by rule.
_BAD_LOANS = {
    "ORIG_AMT": "CASE WHEN CAST(LOAN_ID AS BIGINT) % 13 = 0 THEN NULL ELSE ORIG_AMT END",
    "ORIG_RT": "CASE WHEN CAST(LOAN_ID AS BIGINT) % 17 = 0 THEN NULL ELSE ORIG_RT END",
    "ORIG_TRM": "CASE WHEN CAST(LOAN_ID AS BIGINT) % 7 = 0 THEN 0 WHEN CAST(LOAN_ID AS BIGINT) % 19 = 0 THEN NULL "
                "WHEN CAST(LOAN_ID AS BIGINT) % 23 = 0 THEN -6 WHEN CAST(LOAN_ID AS BIGINT) % 29 = 0 THEN 100000000 "
                "ELSE ORIG_TRM END",
    "LOAN_ID": "CASE WHEN CAST(LOAN_ID AS BIGINT) % 31 = 0 THEN NULL ELSE LOAN_ID END",
}
_BAD_MONTHS = {"LOAN_ID": "CASE WHEN CAST(LOAN_ID AS BIGINT) % 5 = 0 THEN NULL ELSE LOAN_ID END"}
_BAD_LOANS_SQL = ("(SELECT * REPLACE (" + ", ".join(f"{e} AS {c}" for c, e in _BAD_LOANS.items()) + ") FROM loans)")
_BAD_PERF_SQL = ("(SELECT * REPLACE (" + ", ".join(f"{e} AS {c}" for c, e in _BAD_MONTHS.items()) + ") FROM perf)")


def _spoilt(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(rules[c]).cast(df.schema[c].dataType).alias(c) if c in rules else F.col(c)
                       for c in df.columns])


def _spoilt_level(spark, sf):
    return build(_spoilt(fnma_performance(spark, sf), _BAD_MONTHS), _spoilt(fnma_acquisition(spark, sf), _BAD_LOANS),
                 FNMA, MONTH_COUNT)


_REASON_SQL = ("CASE WHEN LOAN_ID IS NULL THEN 'no loan id' WHEN ORIG_AMT IS NULL THEN 'no amount' "
               "WHEN ORIG_RT IS NULL THEN 'no rate' WHEN ORIG_TRM IS NULL THEN 'no term' "
               "WHEN ORIG_TRM <= 0 THEN 'term below one month' WHEN ORIG_TRM > 1200 THEN 'term too long' END")


@register("rejected_loans", f"SELECT LOAN_ID, ORIG_AMT, ORIG_RT, ORIG_TRM, {_REASON_SQL} AS REASON "
                            f"FROM {_BAD_LOANS_SQL} WHERE {_REASON_SQL} IS NOT NULL")
def rejected_loans_q(spark, sf):
    return _spoilt_level(spark, sf).rejected_loans


@register("rejected_months", f"SELECT LOAN_ID, ACT_DTE, LOAN_AGE, 'no loan id' AS REASON FROM {_BAD_PERF_SQL} "
                             "WHERE LOAN_ID IS NULL")
def rejected_months_q(spark, sf):
    return _spoilt_level(spark, sf).rejected_months.select("LOAN_ID", "ACT_DTE", "LOAN_AGE", "REASON")


@register("level_payment_spoilt",
          "SELECT LOAN_ID, ORIG_TRM, round(CASE WHEN ORIG_TRM > 0 THEN ORIG_AMT * (ORIG_RT / 1200.0 / "
          "(1 - pow(1 + ORIG_RT / 1200.0, -CAST(ORIG_TRM AS DOUBLE)))) END, 3) + 0.0 AS PMT FROM " + _BAD_LOANS_SQL)
def level_payment_spoilt_q(spark, sf):
    return with_level_payment(_spoilt_level(spark, sf).loans).select(
        "LOAN_ID", "ORIG_TRM", F.round("PMT", 3).alias("PMT"))


@register("panel_windows_spoilt", "SELECT LOAN_ID, ACT_DTE, LOAN_AGE, " + O.cols(list(WINDOW_COLUMNS)) +
          f" FROM (SELECT *, {O.panel_windows()} FROM {_BAD_PERF_SQL} WHERE LOAN_ID IS NOT NULL)")
def panel_windows_spoilt_q(spark, sf):
    return present(_spoilt_level(spark, sf).panel.select("LOAN_ID", "ACT_DTE", "LOAN_AGE", *WINDOW_COLUMNS))


@register("payment_count_spoilt", f"SELECT LOAN_ID, CAST(max(ORIG_TRM) AS BIGINT) AS N_PAYMENTS FROM {_BAD_LOANS_SQL} "
                                  f"WHERE {_REASON_SQL} IS NULL GROUP BY LOAN_ID")
def payment_count_spoilt_q(spark, sf):
    return payment_table(_spoilt_level(spark, sf).loans).groupBy("LOAN_ID").agg(
        F.count(F.lit(1)).alias("N_PAYMENTS"))


# --- aggregates, order, limits -----------------------------------------------

@register("max_age", "SELECT max(LOAN_AGE) AS max_age FROM perf")
def max_age_q(spark, sf):
    return max_age(keep_columns(_level(spark, sf).perf_base, FNMA.performance))


@register("vintage_count",
          f"SELECT count(*) AS n_loans, count(*) FILTER (WHERE ACQ = '{VINTAGE}') AS n_vintage FROM loans")
def vintage_count_q(spark, sf):
    return _loans(spark, sf).agg(
        F.count(F.lit(1)).alias("n_loans"),
        F.count(F.when(F.col("ACQ") == VINTAGE, 1)).alias("n_vintage"),
    )


@register("term_range", "SELECT max(ORIG_TRM) AS max_term, min(ORIG_TRM) AS min_term FROM loans")
def term_range_q(spark, sf):
    return _loans(spark, sf).agg(F.max("ORIG_TRM").alias("max_term"), F.min("ORIG_TRM").alias("min_term"))


@register("rate_count", "SELECT count(ORIG_RT) AS n_rate FROM loans")
def rate_count_q(spark, sf):
    return _loans(spark, sf).agg(F.count("ORIG_RT").alias("n_rate"))


@register("top_loans", f"SELECT {_LOANS_SQL} FROM loans ORDER BY LOAN_ID, ACQ LIMIT 10")
def top_loans_q(spark, sf):
    return _loans(spark, sf).orderBy("LOAN_ID", "ACQ").limit(10)


@register("vintage_sample", f"SELECT {_LOANS_SQL} FROM loans WHERE ACQ = '{VINTAGE}' ORDER BY LOAN_ID LIMIT 10")
def vintage_sample_q(spark, sf):
    folder = scratch_path(spark, "result")
    path = save_vintage(_loans(spark, sf), folder, "FNMA", "Loan")
    # Partition pruning: only the ACQ=<vintage> folder is listed and read.
    return spark.read.parquet(path).where(F.col("ACQ") == VINTAGE).orderBy("LOAN_ID").limit(10)


# --- amortization --------------------------------------------------------------

@register("level_payment", "SELECT LOAN_ID, ORIG_AMT, ORIG_RT, ORIG_TRM, round(A, 3) + 0.0 AS PMT "
                           "FROM pay JOIN loans USING (LOAN_ID)")
def level_payment_q(spark, sf):
    out = with_level_payment(_loans(spark, sf))
    return out.withColumn("PMT", F.round("PMT", 3))


def _cents_of(df: DataFrame) -> DataFrame:
    return df.withColumn("SCHD_UPB", F.round("SCHD_UPB", 2))


def _long_sql(start: int) -> str:
    return (f"SELECT LOAN_ID, CAST(i + {start} AS INTEGER) AS LOAN_AGE, SCHD_UPB "
            f"FROM {O.recurrence_sql(start, O.month_count_sql(MONTH_COUNT), True)}")


@register("schedule_long", _long_sql(0))
def schedule_long_q(spark, sf):
    return _cents_of(schedule_long(_loans(spark, sf), MONTH_COUNT))


@register("schedule_offset", _long_sql(3))
def schedule_offset_q(spark, sf):
    return _cents_of(schedule_long(_loans(spark, sf), MONTH_COUNT, start_period=3))


@register("schedule_wide",
          "SELECT LOAN_ID, CAST(len(u) AS INTEGER) AS N_MONTHS, "
          + ", ".join(f"u[{i + 1}] AS SCHD_UPB_{i}" for i in range(MONTH_COUNT))
          + " FROM (SELECT LOAN_ID, list(SCHD_UPB ORDER BY i) AS u FROM "
          + O.recurrence_sql(0, O.month_count_sql(MONTH_COUNT), True) + " GROUP BY LOAN_ID)")
def schedule_wide_q(spark, sf):
    wide = schedule_wide(_loans(spark, sf), MONTH_COUNT)
    return wide.select(
        "LOAN_ID",
        F.size("SCHD_UPB").alias("N_MONTHS"),
        *[F.round(F.try_element_at("SCHD_UPB", F.lit(i + 1)), 2).alias(f"SCHD_UPB_{i}")
          for i in range(MONTH_COUNT)],
    )


@register("schedule_ppmt",
          f"SELECT LOAN_ID, CAST(i AS INTEGER) AS LOAN_AGE, round({O.ppmt_balance_sql('i')}, 2) + 0.0 AS SCHD_UPB "
          f"FROM (SELECT *, unnest(range(0, {MONTH_COUNT})) AS i FROM pay)")
def schedule_ppmt_q(spark, sf):
    return _cents_of(schedule_ppmt(_loans(spark, sf), MONTH_COUNT))


@register("schedule_unmasked",
          f"SELECT LOAN_ID, CAST(i AS INTEGER) AS LOAN_AGE, SCHD_UPB FROM {O.recurrence_sql(0, str(MONTH_COUNT), False)}")
def schedule_unmasked_q(spark, sf):
    return _cents_of(schedule_unmasked(_loans(spark, sf), MONTH_COUNT))


def _cents(x: str) -> str:
    return f"(floor({x} * 100 + 0.5) / 100 + 0.0)"


def _payment_sql(level: str) -> str:
    return f"""
SELECT LOAN_ID, PMT_NO, {_cents('BEG_BAL')} AS BEG_BAL, {_cents('PAYMENT')} AS PAYMENT,
       {_cents('PRINCIPAL')} AS PRINCIPAL, {_cents('INTEREST')} AS INTEREST, {_cents('END_BAL')} AS END_BAL
FROM (
  WITH RECURSIVE pt(LOAN_ID, PMT_NO, BEG_BAL, PAYMENT, PRINCIPAL, INTEREST, END_BAL, r, n) AS (
    SELECT LOAN_ID, 1, P, Ac, Ac - {_cents('P * r')}, {_cents('P * r')}, P - (Ac - {_cents('P * r')}), r, n
    FROM (SELECT *, {level} AS Ac FROM pay)
    UNION ALL
    SELECT LOAN_ID, PMT_NO + 1, END_BAL, PAYMENT, PAYMENT - {_cents('END_BAL * r')},
           {_cents('END_BAL * r')}, END_BAL - (PAYMENT - {_cents('END_BAL * r')}), r, n
    FROM pt WHERE PMT_NO < n
  )
  SELECT * FROM pt
)
"""


def _payments(spark, sf, **how) -> DataFrame:
    money = ["BEG_BAL", "PAYMENT", "PRINCIPAL", "INTEREST", "END_BAL"]
    return payment_table(_loans(spark, sf), **how).select(
        "LOAN_ID", "PMT_NO", *[round_half_up(c, 2).alias(c) for c in money])


register("payment_table", _payment_sql("A"))(lambda spark, sf: _payments(spark, sf))
register("payment_table_cents", _payment_sql("floor(A * 100 + 0.5) / 100"))(
    lambda spark, sf: _payments(spark, sf, round_payment=True))


# --- arrays --------------------------------------------------------------------

@register("array_fill_size",
          "SELECT l.LOAN_ID, coalesce(array_to_string(f.F3Q_DLQ_LAGs12, ','), '') AS F3Q_DLQ_LAGs12, "
          "CAST(coalesce(len(f.F3Q_DLQ_LAGs12), 0) AS INTEGER) AS F3Q_DLQ_LAGs12_OrigSize "
          "FROM loans l LEFT JOIN f3q f ON l.LOAN_ID = f.LOAN_ID")
def array_fill_size_q(spark, sf):
    lvl = _level(spark, sf)
    out = loan_with(lvl.loans.select("LOAN_ID"), lvl.first_90d.select("LOAN_ID", "F3Q_DLQ_LAGs12"))
    return present(arr.fill_and_size(out, "F3Q_DLQ_LAGs12"))


@register("array_pad",
          "SELECT l.LOAN_ID, array_to_string(list_concat(list_transform(range(greatest(0, 12 - "
          "coalesce(len(f.F3Q_DLQ_LAGs12), 0))), lambda x: -1), coalesce(f.F3Q_DLQ_LAGs12, []::INTEGER[])), ',') "
          "AS F3Q_DLQ_LAGs12 FROM loans l LEFT JOIN f3q f ON l.LOAN_ID = f.LOAN_ID")
def array_pad_q(spark, sf):
    lvl = _level(spark, sf)
    out = loan_with(lvl.loans.select("LOAN_ID"), lvl.first_90d.select("LOAN_ID", "F3Q_DLQ_LAGs12"))
    return present(arr.pad_array(out, "F3Q_DLQ_LAGs12", 12))


@register("array_columns", _expanded_sql(
    "(SELECT l.LOAN_ID, f.F3Q_AGE, f.F3Q_DLQ_LAGs12 FROM loans l LEFT JOIN f3q f ON l.LOAN_ID = f.LOAN_ID)",
    "F3Q_DLQ_LAGs12", extra=", F3Q_AGE"))
def array_columns_q(spark, sf):
    lvl = _level(spark, sf)
    out = loan_with(lvl.loans.select("LOAN_ID"), lvl.first_90d.select("LOAN_ID", "F3Q_AGE", "F3Q_DLQ_LAGs12"))
    out = arr.expand_array(out, "F3Q_DLQ_LAGs12", 12)
    return out.select("LOAN_ID", "F3Q_AGE", "F3Q_DLQ_LAGs12_OrigSize", *[f"F3Q_DLQ_LAGs12_{i}" for i in range(12)])


# --- second agency through the same code path ------------------------------------


def _fred_text(spark, sf, kind: str) -> str:
    path = scratch_path(spark, f"fred-{kind}-text")
    if kind == "acquisition":
        write_tape(fred_acquisition(spark, sf), path, FRED.acquisition)
    else:
        write_tape(fred_performance(spark, sf), path, FRED.performance)
    return path


@register("fred_scan_acquisition", f"SELECT {', '.join(O.FRED_LOAN_KEEP)} FROM fred_loans")
def fred_scan_acquisition_q(spark, sf):
    return read_acquisition(spark, _fred_text(spark, sf, "acquisition"), FRED)


@register("fred_scan_performance",
          f"SELECT {', '.join(O.FRED_PERF_KEEP)} FROM fred_perf WHERE LOAN_AGE >= 0")
def fred_scan_performance_q(spark, sf):
    return read_performance(spark, _fred_text(spark, sf, "performance"), FRED)


@register("fred_default_totals", "SELECT LOAN_ID, ACT_DTE, DEFT_COST, DEFT_PROCS FROM fred_perf")
def fred_default_totals_q(spark, sf):
    return build(fred_performance(spark, sf), None, FRED).perf_base.select(
        "LOAN_ID", "ACT_DTE", "DEFT_COST", "DEFT_PROCS")


@register("fred_loan_outcome",
          f"SELECT {O.cols(O.FRED_LOAN_KEEP, 'l.')}, "
          f"{O.cols(O.MOD_COLS[1:], 'm.')}, {O.cols(O.F3Q_COLS[1:], 'f.')}, {O.cols(O.ZB_COLS[1:], 'z.')} "
          "FROM fred_loans l LEFT JOIN fred_modf m ON l.LOAN_ID = m.LOAN_ID "
          "LEFT JOIN fred_f3q f ON l.LOAN_ID = f.LOAN_ID LEFT JOIN fred_zb z ON l.LOAN_ID = z.LOAN_ID")
def fred_loan_outcome_q(spark, sf):
    lvl = build(read_tape(spark, _fred_text(spark, sf, "performance"), FRED.performance),
                read_tape(spark, _fred_text(spark, sf, "acquisition"), FRED.acquisition), FRED, MONTH_COUNT)
    return present(lvl.outcome())


_FRED_PWS_COLS = ", ".join(
    f"coalesce(p.LAST_UPB, {_FILL_SQL}) AS LAST_UPB"
    if c == "LAST_UPB" else f"p.{c}" for c in O.FRED_PERF_KEEP
)


@register("fred_panel_with_schedule",
          f"SELECT {_FRED_PWS_COLS} FROM fred_perf p LEFT JOIN "
          f"(SELECT *, {O.month_count_sql(MONTH_COUNT, 'fred_loans')} AS N FROM fred_pay) s "
          "ON p.LOAN_ID = s.LOAN_ID AND p.LOAN_AGE < s.N WHERE p.LOAN_AGE >= 0")
def fred_panel_with_schedule_q(spark, sf):
    lvl = build(read_tape(spark, _fred_text(spark, sf, "performance"), FRED.performance),
                read_tape(spark, _fred_text(spark, sf, "acquisition"), FRED.acquisition), FRED, MONTH_COUNT)
    return lvl.performance()
