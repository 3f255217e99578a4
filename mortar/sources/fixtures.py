"""Loan tapes derived from the driver tables.

The test tables hold no loans, so the FNMA tapes are mapped from ``orders``
(one loan per order) and ``events`` (one loan per user, one month per
event).  The expressions are Spark SQL so that they read the same as the
mapping document; every column of the tape grows with the input tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.skew import row_positions


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- fixed values: fixture mapping (orders -> acquisition tape) -------------
# ``ADDM(d, n)`` adds n months and ``TEXT`` is the string type; both are
# rendered per SQL dialect by ``render``.
FNMA_ACQUISITION_EXPRS = [
    "cast(o_orderkey as TEXT) as LOAN_ID",
    "case o_orderkey % 3 when 0 then 'R' when 1 then 'B' else 'C' end as ORIG_CHN",
    "'Seller' || cast(o_custkey % 5 as TEXT) as SellerName",
    "cast(2.0 + (o_orderkey % 41) * 0.125 as double) as ORIG_RT",
    "o_totalprice as ORIG_AMT",
    "cast(case o_orderkey % 5 when 0 then 6 when 1 then 10 when 2 then 120 when 3 then 180 else 360 end as int) as ORIG_TRM",
    "cast(date_trunc('month', o_orderdate) as date) as ORIG_DTE",
    "ADDM(cast(date_trunc('month', o_orderdate) as date), 2) as FRST_DTE",
    "cast(case when o_orderkey % 7 = 0 then null else 60 + o_orderkey % 37 end as double) as OLTV",
    "cast(case when o_orderkey % 11 = 0 then null when o_orderkey % 13 = 0 then 0 else 65 + o_orderkey % 31 end as double) as OCLTV",
    "cast(case when o_orderkey % 10 = 0 then null else 1 + o_orderkey % 2 end as int) as NUM_BO",
    "cast(case when o_orderkey % 8 = 0 then null else 20 + o_orderkey % 30 end as int) as DTI",
    "cast(case when o_orderkey % 17 = 0 then null else 620 + o_orderkey % 200 end as double) as CSCORE_B",
    "case o_orderkey % 3 when 0 then 'Y' when 1 then 'N' else 'U' end as FTHB_FLG",
    "o_orderstatus as PURPOSE",
    "case o_orderkey % 2 when 0 then 'SF' else 'CO' end as PROP_TYP",
    "cast(case when o_orderkey % 19 = 0 then null else 1 + o_orderkey % 4 end as int) as NUM_UNIT",
    "case o_orderkey % 4 when 0 then 'I' else 'P' end as OCC_STAT",
    "'S' || cast(o_custkey % 50 as TEXT) as STATE",
    "cast(100 + o_custkey % 900 as TEXT) as ZIP_3",
    "cast(case when o_orderkey % 3 = 0 then 25 else null end as int) as MI_PCT",
    "'FRM' as Product_Type",
    "cast(case when o_orderkey % 2 = 0 then null else 640 + o_orderkey % 150 end as int) as CSCORE_C",
    "case when o_orderkey % 3 = 0 then '1' else null end as MI_TYPE",
    "case when o_orderkey % 23 = 0 then 'Y' else 'N' end as RELOCATION_FLG",
    "cast(year(o_orderdate) as TEXT) || 'Q' || cast(quarter(o_orderdate) as TEXT) as ACQ",
]

# (events numbered per user: k = 0, 1, ... in (ts, event_id) order)
_ZB = "event_type = 'purchase' and event_id % 40 = 0"
FNMA_PERFORMANCE_EXPRS = [
    "cast(user_id as TEXT) as LOAN_ID",
    "ADDM(cast('2000-01-01' as date), k) as ACT_DTE",
    "'Servicer' || cast(user_id % 4 as TEXT) as SERVICER",
    "cast(2.0 + (user_id % 41) * 0.125 as double) as LAST_RT",
    "case when k < 8 then null else value * 1000 end as LAST_UPB",
    "cast(k - 2 as int) as LOAN_AGE",
    "cast(case when event_id % 13 = 0 then null else 362 - k end as int) as Months_To_Legal_Mat",
    "cast(case when event_id % 11 = 0 then null else 361 - k end as int) as Adj_Month_To_Mat",
    "cast('2030-01-01' as date) as Maturity_Date",
    "cast(10000 + user_id % 300 as TEXT) as MSA",
    "case when event_type = 'error' then 'X' when event_type = 'click' then null else cast(event_id % 6 as TEXT) end as DLQ_STATUS",
    "case when event_type = 'signup' and event_id % 4 = 0 then 'Y' else 'N' end as MOD_FLAG",
    f"case when {_ZB} then '0' || cast(1 + user_id % 9 as TEXT) else null end as ZB_CODE",
    f"case when {_ZB} then ADDM(cast('2000-01-01' as date), k) else null end as ZB_DTE",
    f"case when {_ZB} then ADDM(cast('2000-01-01' as date), k) else null end as LPI_DTE",
    f"case when {_ZB} then ADDM(cast('2000-01-01' as date), k) else null end as FCC_DTE",
    f"case when {_ZB} then ADDM(cast('2000-01-01' as date), k) else null end as DISP_DTE",
    "cast(case when event_id % 29 = 0 then null else (event_id % 97) * 5 end as double) as FCC_COST",
    "cast(case when event_id % 30 = 0 then null else (event_id % 98) * 5 end as double) as PP_COST",
    "cast(case when event_id % 31 = 0 then null else (event_id % 99) * 5 end as double) as AR_COST",
    "cast(case when event_id % 32 = 0 then null else (event_id % 100) * 5 end as double) as IE_COST",
    "cast(case when event_id % 33 = 0 then null else (event_id % 101) * 5 end as double) as TAX_COST",
    "cast(case when event_id % 34 = 0 then null else (event_id % 102) * 5 end as double) as NS_PROCS",
    "cast(case when event_id % 35 = 0 then null else (event_id % 103) * 5 end as double) as CE_PROCS",
    "cast(case when event_id % 36 = 0 then null else (event_id % 104) * 5 end as double) as RMW_PROCS",
    "cast(case when event_id % 37 = 0 then null else (event_id % 105) * 5 end as double) as O_PROCS",
    "cast(0 as double) as NON_INT_UPB",
    "cast(0 as double) as PRIN_FORG_UPB_FHFA",
    "'N' as REPCH_FLAG",
    "'0' as PRIN_FORG_UPB_OTH",
    "'N' as TRANSFER_FLG",
]
# --- end of fixed values ------------------------------------------------------


def _addm(expr: str, dialect: str) -> str:
    # ADDM(d, n) -> engine form; the date argument may hold parentheses, so
    # the call's end is found by matching them.
    while "ADDM(" in expr:
        start = expr.index("ADDM(")
        depth, i = 0, start + 4
        while True:
            if expr[i] == "(":
                depth += 1
            elif expr[i] == ")":
                depth -= 1
                if depth == 0:
                    break
            i += 1
        inner = expr[start + 5:i]
        d, n = inner.rsplit(", ", 1)
        if dialect == "spark":
            rep = f"add_months({d}, {n})"
        else:
            rep = f"cast({d} + to_months({n}) as date)"
        expr = expr[:start] + rep + expr[i + 1:]
    return expr


def render(exprs: list[str], dialect: str = "spark") -> list[str]:
    """Render the mapping for ``spark`` or ``duckdb``."""
    text = "string" if dialect == "spark" else "varchar"
    return [_addm(e.replace(" as TEXT)", f" as {text})"), dialect) for e in exprs]


def fnma_acquisition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw FNMA loan tape (typed, before cleaning) plus the vintage ``ACQ``."""
    return table(spark, sf_dir, "orders").selectExpr(*render(FNMA_ACQUISITION_EXPRS))


# Users with more events than this are numbered by the split path.
HOT_USER_ROWS = 1_000_000


def numbered_events(spark: SparkSession, sf_dir: str, hot_threshold: int | None = HOT_USER_ROWS) -> DataFrame:
    """Events with their 0-based month index k per user, in (ts, event_id) order.

    A user holding a large share of the events is numbered across many tasks
    (``operators.skew.row_positions``) rather than in one window partition.
    """
    return row_positions(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], hot_threshold, "k")


def fnma_performance(spark: SparkSession, sf_dir: str, hot_threshold: int | None = HOT_USER_ROWS) -> DataFrame:
    """Raw FNMA monthly tape (typed dates, status still text)."""
    return numbered_events(spark, sf_dir, hot_threshold).selectExpr(*render(FNMA_PERFORMANCE_EXPRS))


# --- fixed values: FRED fixture mapping (this engine's own definition) --------
# Columns shared with the FNMA tapes reuse the FNMA expressions by name.
FRED_ACQUISITION_EXTRA = {
    "LOAN_ID": "'F' || cast(o_orderkey as TEXT) as LOAN_ID",
    "MAT_DTE": "ADDM(cast(date_trunc('month', o_orderdate) as date), 2 + cast(case o_orderkey % 5 when 0 then 6 "
               "when 1 then 10 when 2 then 120 when 3 then 180 else 360 end as int)) as MAT_DTE",
    "MSA": "cast(10000 + o_custkey % 300 as TEXT) as MSA",
    "ppmt_pnlty": "case when o_orderkey % 29 = 0 then 'Y' else 'N' end as ppmt_pnlty",
    "SERVICER": "'Servicer' || cast(o_custkey % 4 as TEXT) as SERVICER",
    "flag_sc": "case when o_orderkey % 31 = 0 then 'Y' else null end as flag_sc",
}
FRED_PERFORMANCE_EXTRA = {
    "LOAN_ID": "'F' || cast(user_id as TEXT) as LOAN_ID",
    "EXpenses": "cast(case when event_id % 38 = 0 then null else (event_id % 106) * 5 end as double) as EXpenses",
    "LEGAL_COST": "cast(case when event_id % 29 = 0 then null else (event_id % 97) * 5 end as double) as LEGAL_COST",
    "MAINT_COST": "cast(case when event_id % 30 = 0 then null else (event_id % 98) * 5 end as double) as MAINT_COST",
    "MISC_COST": "cast(case when event_id % 32 = 0 then null else (event_id % 100) * 5 end as double) as MISC_COST",
    "ACTUAL_LOSS": f"case when {_ZB} then cast((event_id % 50) * 100 as double) else null end as ACTUAL_LOSS",
    "MOD_LOSS": "cast(0 as double) as MOD_LOSS",
    "STEPMOD_IND": "'N' as STEPMOD_IND",
    "DPM_IND": "'N' as DPM_IND",
    "ELTV": "cast(60 + user_id % 40 as double) as ELTV",
}
# --- end of fixed values ------------------------------------------------------


def _by_name(exprs: list[str]) -> dict[str, str]:
    return {e.rsplit(" as ", 1)[1]: e for e in exprs}


def fred_exprs(kind: str) -> list[str]:
    """FRED tape expressions in FRED file order (acquisition adds ``ACQ``)."""
    from ..schema import FRED
    if kind == "acquisition":
        base, extra, names = _by_name(FNMA_ACQUISITION_EXPRS), FRED_ACQUISITION_EXTRA, FRED.acquisition.names + ["ACQ"]
    else:
        base, extra, names = _by_name(FNMA_PERFORMANCE_EXPRS), FRED_PERFORMANCE_EXTRA, FRED.performance.names
    return [extra.get(n) or base[n] for n in names]


def fred_acquisition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*render(fred_exprs("acquisition")))


def fred_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered_events(spark, sf_dir).selectExpr(*render(fred_exprs("performance")))
