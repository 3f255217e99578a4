"""DuckDB SQL building blocks for the oracle side of every query.

The fixture tapes, the cleaning rules, the window features and the event
tables are written once here as CTEs over the driver's pre-registered views
(``orders``, ``events``); each query's oracle is ``WITH <ctes> SELECT ...``.
DuckDB drops the CTEs a query does not reference.
"""

from __future__ import annotations

from ..schema import FNMA, FRED, Agency
from ..sources.fixtures import FNMA_ACQUISITION_EXPRS, FNMA_PERFORMANCE_EXPRS, fred_exprs, render

W = "PARTITION BY LOAN_ID ORDER BY ACT_DTE, LOAN_AGE"


# --- fixed values: the cleaned tapes, written out from the tape layouts ---------
# Kept apart from the schema registry on purpose: a wrong default, keep flag
# or cost list there must disagree with the text here.
LOAN_KEEP = """LOAN_ID ORIG_CHN ORIG_RT ORIG_AMT ORIG_TRM ORIG_DTE FRST_DTE OLTV OCLTV NUM_BO DTI CSCORE_B FTHB_FLG
PURPOSE PROP_TYP NUM_UNIT OCC_STAT STATE ZIP_3 MI_PCT Product_Type CSCORE_C MI_TYPE RELOCATION_FLG""".split()
PERF_KEEP = """LOAN_ID ACT_DTE LAST_RT LAST_UPB LOAN_AGE Months_To_Legal_Mat Adj_Month_To_Mat Maturity_Date DLQ_STATUS
NON_INT_UPB PRIN_FORG_UPB_FHFA REPCH_FLAG PRIN_FORG_UPB_OTH TRANSFER_FLG""".split()
FRED_LOAN_KEEP = """CSCORE_B FRST_DTE FTHB_FLG MAT_DTE MI_PCT NUM_UNIT OCC_STAT OCLTV DTI ORIG_AMT OLTV ORIG_RT ORIG_CHN
ppmt_pnlty Product_Type STATE PROP_TYP ZIP_3 LOAN_ID PURPOSE ORIG_TRM NUM_BO""".split()
FRED_PERF_KEEP = """LOAN_ID ACT_DTE LAST_UPB DLQ_STATUS LOAN_AGE Months_To_Legal_Mat REPCH_FLAG LAST_RT NON_INT_UPB
ACTUAL_LOSS MOD_LOSS""".split()
LOAN_DEFAULTS = {
    "OLTV": "CAST(0 AS DOUBLE)", "OCLTV": "CAST(0 AS DOUBLE)", "NUM_BO": "-1", "DTI": "-1",
    "CSCORE_B": "CAST(-1 AS DOUBLE)", "NUM_UNIT": "-1", "MI_PCT": "0", "CSCORE_C": "-1", "MI_TYPE": "'0'",
}
FRED_LOAN_DEFAULTS = {
    "CSCORE_B": "CAST(-1 AS DOUBLE)", "MI_PCT": "0", "NUM_UNIT": "-1", "OCLTV": "CAST(0 AS DOUBLE)", "DTI": "-1",
    "OLTV": "CAST(0 AS DOUBLE)", "NUM_BO": "-1",
}
PERF_DEFAULTS = {"Months_To_Legal_Mat": "-1", "Adj_Month_To_Mat": "-1"}
PERF_ALL = """LOAN_ID ACT_DTE SERVICER LAST_RT LAST_UPB LOAN_AGE Months_To_Legal_Mat Adj_Month_To_Mat Maturity_Date MSA
DLQ_STATUS MOD_FLAG ZB_CODE ZB_DTE LPI_DTE FCC_DTE DISP_DTE FCC_COST PP_COST AR_COST IE_COST TAX_COST NS_PROCS CE_PROCS
RMW_PROCS O_PROCS NON_INT_UPB PRIN_FORG_UPB_FHFA REPCH_FLAG PRIN_FORG_UPB_OTH TRANSFER_FLG""".split()
FRED_PERF_ALL = """LOAN_ID ACT_DTE LAST_UPB DLQ_STATUS LOAN_AGE Months_To_Legal_Mat REPCH_FLAG MOD_FLAG ZB_CODE ZB_DTE
LAST_RT NON_INT_UPB LPI_DTE CE_PROCS NS_PROCS RMW_PROCS EXpenses LEGAL_COST MAINT_COST TAX_COST MISC_COST ACTUAL_LOSS
MOD_LOSS STEPMOD_IND DPM_IND ELTV""".split()
TOTALS = """FCC_COST + PP_COST + AR_COST + IE_COST + TAX_COST AS DEFT_COST,
NS_PROCS + CE_PROCS + RMW_PROCS + O_PROCS AS DEFT_PROCS"""
FRED_TOTALS = """LEGAL_COST + MAINT_COST + TAX_COST + MISC_COST AS DEFT_COST,
NS_PROCS + CE_PROCS + RMW_PROCS AS DEFT_PROCS"""
# --- end of fixed values ----------------------------------------------------------


def filled(names: list[str], defaults: dict[str, str]) -> str:
    """Select list with the defaults of null columns."""
    return ", ".join(f"coalesce({n}, {defaults[n]}) AS {n}" if n in defaults else n for n in names)


def _loans_select(ag: Agency) -> str:
    names, defaults = (LOAN_KEEP, LOAN_DEFAULTS) if ag is FNMA else (FRED_LOAN_KEEP, FRED_LOAN_DEFAULTS)
    ltv = ("CASE WHEN OCLTV IS NULL OR OCLTV = 0 THEN coalesce(OLTV, CAST(0 AS DOUBLE)) ELSE OCLTV END AS OCLTV")
    return ", ".join(ltv if n == "OCLTV" else filled([n], defaults) for n in names) + ", ACQ"


DLQ_SQL = ("case when DLQ_STATUS is null then -1 when DLQ_STATUS = 'X' then -2 "
           "else try_cast(DLQ_STATUS as integer) end")


def _perf_select(ag: Agency) -> str:
    names, totals = (PERF_ALL, TOTALS) if ag is FNMA else (FRED_PERF_ALL, FRED_TOTALS)
    return ", ".join(DLQ_SQL + " AS DLQ_STATUS" if n == "DLQ_STATUS" else n for n in names) + ", " + totals


def panel_windows(order: str = "ACT_DTE, LOAN_AGE") -> str:
    """The eight window columns in the given time order."""
    w = f"PARTITION BY LOAN_ID ORDER BY {order}"

    def frame(lo: str, hi: str) -> str:
        return f"({w} ROWS BETWEEN {lo} AND {hi})"

    return ", ".join([
        f"lag(DLQ_STATUS, 1) OVER ({w}) AS DLQ_LAG",
        f"list(DLQ_STATUS ORDER BY {order}) OVER {frame('12 PRECEDING', '1 PRECEDING')} AS DLQ_LAGs12",
        f"max(DLQ_STATUS) OVER {frame('1 FOLLOWING', '12 FOLLOWING')} AS DLQ_NEXT12MAX",
        f"max(DLQ_STATUS) OVER {frame('1 FOLLOWING', '24 FOLLOWING')} AS DLQ_NEXT24MAX",
        f"max(ZB_CODE) OVER {frame('1 FOLLOWING', '12 FOLLOWING')} AS ZBCODE_NEXT12",
        f"max(ZB_CODE) OVER {frame('1 FOLLOWING', '24 FOLLOWING')} AS ZBCODE_NEXT24",
        f"max(MOD_FLAG) OVER {frame('1 FOLLOWING', '12 FOLLOWING')} AS MOD_NEXT12",
        f"max(MOD_FLAG) OVER {frame('1 FOLLOWING', '24 FOLLOWING')} AS MOD_NEXT24",
    ])


# The whole order, for months that a loan reports twice.
TOTAL_ORDER = ", ".join(f"{c} NULLS FIRST" for c in (
    "ACT_DTE LOAN_AGE DLQ_STATUS ZB_CODE MOD_FLAG LAST_UPB ZB_DTE LPI_DTE FCC_DTE DISP_DTE DEFT_COST DEFT_PROCS").split())

MOD_COLS = ["LOAN_ID", "MOD_DTE", "MOD_AGE", "MOD_DLQ", "MOD_DLQ_LAG", "MOD_DLQ_LAGs12",
            "MOD_POST_MAXDLQ_12", "MOD_POST_MAXDLQ_24", "MOD_POST_ZBCODE_12", "MOD_POST_ZBCODE_24"]
F3Q_COLS = ["LOAN_ID", "F3Q_DTE", "F3Q_AGE", "F3Q_DLQ_LAGs12", "F3Q_POST_MAXDLQ_12",
            "F3Q_POST_MAXDLQ_24", "F3Q_POST_ZBCODE_12", "F3Q_POST_ZBCODE_24"]
ZB_COLS = ["LOAN_ID", "ZB_CODE", "ZB_DTE", "ZB_AGE", "ZB_DLQ_LAGs12", "ZB_DLQ_LAG", "ZB_LAST_UPB",
           "LPI_DTE", "FCC_DTE", "DISP_DTE", "DEFT_COST", "DEFT_PROCS"]
LOAN_COLS = [*LOAN_KEEP, "ACQ"]
ARRAY_COLS = {"DLQ_LAGs12", "MOD_DLQ_LAGs12", "F3Q_DLQ_LAGs12", "ZB_DLQ_LAGs12"}

def _date_sql(ag: Agency, name: str) -> str:
    return name if name in (PERF_ALL if ag is FNMA else FRED_PERF_ALL) else f"cast(NULL AS DATE) AS {name}"


def agency_ctes(ag: Agency, p: str, acq_exprs: list[str], perf_exprs: list[str]) -> str:
    """Tapes, cleaning, windows and event tables of one agency; names prefixed by ``p``."""
    return f"""
{p}acq_raw AS (SELECT {", ".join(render(acq_exprs, "duckdb"))} FROM orders),
{p}perf_raw AS (SELECT {", ".join(render(perf_exprs, "duckdb"))} FROM ev),
{p}loans AS (SELECT {_loans_select(ag)} FROM {p}acq_raw),
{p}perf AS (SELECT {_perf_select(ag)} FROM {p}perf_raw),
{p}panel AS (SELECT *, {panel_windows()} FROM {p}perf),
{p}modf AS (
  SELECT LOAN_ID, ACT_DTE AS MOD_DTE, LOAN_AGE AS MOD_AGE, DLQ_STATUS AS MOD_DLQ,
         DLQ_LAG AS MOD_DLQ_LAG, DLQ_LAGs12 AS MOD_DLQ_LAGs12,
         DLQ_NEXT12MAX AS MOD_POST_MAXDLQ_12, DLQ_NEXT24MAX AS MOD_POST_MAXDLQ_24,
         ZBCODE_NEXT12 AS MOD_POST_ZBCODE_12, ZBCODE_NEXT24 AS MOD_POST_ZBCODE_24
  FROM {p}panel WHERE MOD_FLAG = 'Y'
  QUALIFY row_number() OVER ({W}) = 1),
{p}f3q AS (
  SELECT LOAN_ID, ACT_DTE AS F3Q_DTE, LOAN_AGE AS F3Q_AGE, DLQ_LAGs12 AS F3Q_DLQ_LAGs12,
         DLQ_NEXT12MAX AS F3Q_POST_MAXDLQ_12, DLQ_NEXT24MAX AS F3Q_POST_MAXDLQ_24,
         ZBCODE_NEXT12 AS F3Q_POST_ZBCODE_12, ZBCODE_NEXT24 AS F3Q_POST_ZBCODE_24
  FROM {p}panel WHERE DLQ_STATUS > 2
  QUALIFY row_number() OVER ({W}) = 1),
{p}zb AS (
  SELECT LOAN_ID, ZB_CODE, ZB_DTE, LOAN_AGE AS ZB_AGE, DLQ_LAGs12 AS ZB_DLQ_LAGs12,
         DLQ_LAG AS ZB_DLQ_LAG, LAST_UPB AS ZB_LAST_UPB, {_date_sql(ag, "LPI_DTE")},
         {_date_sql(ag, "FCC_DTE")}, {_date_sql(ag, "DISP_DTE")}, DEFT_COST, DEFT_PROCS
  FROM {p}panel WHERE ZB_CODE IS NOT NULL)"""


CTES = f"""
ev AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS k FROM events),
{agency_ctes(FNMA, "", FNMA_ACQUISITION_EXPRS, FNMA_PERFORMANCE_EXPRS).strip()},
terms AS (SELECT LOAN_ID, ORIG_AMT AS P, ORIG_RT / 1200.0 AS r, ORIG_TRM AS n FROM loans),
pay AS (SELECT *, CASE WHEN r = 0 THEN P / n ELSE P * (r / (1 - pow(1 + r, -n))) END AS A FROM terms),
{agency_ctes(FRED, "fred_", fred_exprs("acquisition"), fred_exprs("performance")).strip()},
fred_terms AS (SELECT LOAN_ID, ORIG_AMT AS P, ORIG_RT / 1200.0 AS r, ORIG_TRM AS n FROM fred_loans),
fred_pay AS (SELECT *, CASE WHEN r = 0 THEN P / n ELSE P * (r / (1 - pow(1 + r, -n))) END AS A FROM fred_terms)
"""


def with_ctes(select: str) -> str:
    return f"WITH {CTES.strip()}\n{select.strip()}"


def cols(names: list[str], prefix: str = "") -> str:
    """Select list; array columns rendered as comma-joined text ('' for none)."""
    out = []
    for n in names:
        ref = f"{prefix}{n}"
        if n in ARRAY_COLS:
            out.append(f"coalesce(array_to_string({ref}, ','), '') AS {n}")
        else:
            out.append(ref if not prefix else f"{ref} AS {n}")
    return ", ".join(out)


def balance_sql(t: str) -> str:
    """Closed-form unmasked balance after t payments (same operation order as Spark)."""
    g = f"pow(1 + r, {t})"
    return f"(CASE WHEN r = 0 THEN P - A * ({t}) ELSE P * {g} - A * ({g} - 1) / r END)"


def recurrence_sql(start: int, months: str, masked: bool) -> str:
    """(LOAN_ID, i, SCHD_UPB): balances start .. start + months - 1 by the payment recurrence.

    Month by month B(t) = B(t-1) - (A - B(t-1) r), so it shares nothing with
    the engine's closed form; compared in cents.
    """
    cell = ("CASE WHEN t = start_at OR t < n THEN B WHEN t = n THEN 0.0 WHEN t > n THEN -999.0 END"
            if masked else "B")
    return f"""(
  WITH RECURSIVE rb(LOAN_ID, n, r, A, t, B, months, start_at) AS (
    SELECT LOAN_ID, n, r, A, 0, P, {months}, {start} FROM pay
    UNION ALL
    SELECT LOAN_ID, n, r, A, t + 1, B - (A - B * r), months, start_at FROM rb WHERE t + 1 < start_at + months)
  SELECT LOAN_ID, t - start_at AS i, round({cell}, 2) + 0.0 AS SCHD_UPB FROM rb WHERE t >= start_at)"""


def ppmt_balance_sql(t: str) -> str:
    """P less the sum of the principal parts of payments 1..t, part by part."""
    return f"(P - coalesce(list_sum([(A - P * r) * pow(1 + r, j) FOR j IN range(0, {t})]), 0))"


def masked_cell_sql(i: str, start: int) -> str:
    t = f"({i} + {start})"
    return (f"(CASE WHEN {i} = 0 THEN {balance_sql(t)} WHEN {t} < n THEN {balance_sql(t)} "
            f"WHEN {t} = n THEN 0.0 WHEN {t} > n THEN -999.0 END)")


def month_count_sql(end_minus_start: int | None, loans: str = "loans") -> str:
    if end_minus_start is None:
        return f"(SELECT max(ORIG_TRM) FROM {loans})"
    return f"(SELECT least(max(ORIG_TRM), {max(1, end_minus_start)}) FROM {loans})"
