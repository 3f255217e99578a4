"""Adjustable-rate terms and market series derived from the driver tables.

The test tables hold no markets: terms of adjustable loans, index rates, rate
quotes and house prices are mapped from ``orders`` (one adjustable loan per
order, one observation per order, month and name).  Everything grows with the
table.  This mapping is the engine's own; the expressions read the same in
Spark and DuckDB after ``render``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .fixtures import FNMA_ACQUISITION_EXPRS, render, table

# --- fixed values: adjustable terms (orders) -------------------------------------
_FROM_LOAN = ("LOAN_ID", "ORIG_AMT", "ORIG_RT", "ORIG_TRM", "FRST_DTE")
ARM_EXPRS = [
    *[e for e in FNMA_ACQUISITION_EXPRS if e.rsplit(" as ", 1)[1] in _FROM_LOAN],
    "case o_orderkey % 4 when 0 then 'hybrid' when 1 then 'interest_only' when 2 then 'payment_option' else 'stepped' end"
    " as ARM_TYPE",
    "case when o_orderkey % 4 = 3 then null when o_orderkey % 3 = 0 then 'CMT1' when o_orderkey % 3 = 1 then 'LIBOR'"
    " else 'COFI' end as INDEX_NAME",
    "case when o_orderkey % 4 = 3 then null else cast(1.5 + (o_orderkey % 7) * 0.25 as double) end as MARGIN",
    "cast(case o_orderkey % 4 when 2 then 1 when 3 then 24 else 12 + 24 * (o_custkey % 3) end as int) as FIRST_RESET",
    "cast(case o_orderkey % 4 when 2 then 1 when 1 then 6 else 12 end as int) as RESET_EVERY",
    "cast(case when o_orderkey % 4 >= 2 then null else 2 + o_custkey % 4 end as double) as INIT_CAP",
    "cast(case when o_orderkey % 4 >= 2 then null else 1 + o_custkey % 2 end as double) as PERIODIC_CAP",
    "cast(case o_orderkey % 4 when 3 then null when 2 then 9 else 5 end as double) as LIFE_CAP",
    "case when o_orderkey % 8 = 0 then cast(1.5 + (o_orderkey % 7) * 0.25 as double) else null end as RATE_FLOOR",
    "cast(case when o_orderkey % 4 = 2 then 12 else null end as int) as PAY_EVERY",
    "case when o_orderkey % 4 = 2 then cast(0.075 as double) else null end as PAY_CAP",
    "cast(case when o_orderkey % 4 = 2 then 60 else null end as int) as RECAST_EVERY",
    "case when o_orderkey % 4 = 2 then cast(1.125 as double) else null end as NEG_LIMIT",
    "cast(case when o_orderkey % 4 = 1 then 36 + 24 * (o_custkey % 4) else 0 end as int) as IO_MONTHS",
    "case when o_orderkey % 4 = 3 then cast(0.5 as double) else null end as STEP_SIZE",
    "cast(case when o_orderkey % 4 = 3 then 1 + o_custkey % 5 else null end as int) as STEPS",
]

# --- fixed values: monthly index rates, one a name and month ----------------------
INDEX_KEYS = ["case o_custkey % 3 when 0 then 'CMT1' when 1 then 'LIBOR' else 'COFI' end as INDEX_NAME",
              "cast(date_trunc('month', o_orderdate) as date) as MONTH"]
INDEX_VALUE = "cast(1 + (sum(o_orderkey) % 49) * 0.125 as double) as VALUE"

# --- fixed values: market rate quotes (the orders' dates, 66 months on) -----------
QUOTE_KEYS = ["cast(case o_orderkey % 4 when 0 then 120 when 1 then 180 when 2 then 240 else 360 end as int) as TERM_BUCKET",
              "ADDM(cast(o_orderdate as date), 66) as QUOTE_DTE"]
QUOTE_VALUE = "cast(3 + (sum(o_custkey) % 41) * 0.125 as double) as MKT_RT"

# --- fixed values: house prices by ZIP3, state and nation -------------------------
# Every second month from 1995 on, so that the months between are missing.
_HPI_MONTH = ("ADDM(cast('1995-01-01' as date), 2 * ((year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1)) as MONTH")
_ZIP, _STATE = "cast(100 + o_custkey % 900 as TEXT)", "'S' || cast(o_custkey % 50 as TEXT)"
HPI_LEVELS = [
    ["'ZIP3' as LEVEL", f"{_ZIP} as REGION", _HPI_MONTH, "o_custkey % 900 < 300"],
    ["'STATE' as LEVEL", f"{_STATE} as REGION", _HPI_MONTH, "o_custkey % 50 < 35"],
    ["'NATION' as LEVEL", "'US' as REGION", _HPI_MONTH, "1 = 1"],
]
HPI_VALUE = "cast(100 + sum(o_orderkey) % 160 as double) as HPI"
# --- end of fixed values ----------------------------------------------------------


def arm_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of the adjustable loans, one per order."""
    return table(spark, sf_dir, "orders").selectExpr(*render(ARM_EXPRS))


def _observed(orders: DataFrame, keys: list[str], value: str) -> DataFrame:
    keyed = orders.selectExpr("*", *render(keys))
    names = [k.rsplit(" as ", 1)[1] for k in keys]
    expr, name = value.rsplit(" as ", 1)
    return keyed.groupBy(*names).agg(F.expr(expr).alias(name))


def index_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(INDEX_NAME, MONTH, VALUE) in percent."""
    return _observed(table(spark, sf_dir, "orders"), INDEX_KEYS, INDEX_VALUE)


def rate_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(TERM_BUCKET, QUOTE_DTE, MKT_RT): market rates by term, on the days that have one."""
    return _observed(table(spark, sf_dir, "orders"), QUOTE_KEYS, QUOTE_VALUE)


def house_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(LEVEL, REGION, MONTH, HPI) of ZIP3s, states and the nation."""
    orders = table(spark, sf_dir, "orders")
    parts = [_observed(orders.where(keys[-1]), keys[:-1], HPI_VALUE) for keys in HPI_LEVELS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def observed_sql(keys: list[str], value: str, where: str = "1 = 1") -> str:
    """The same observations as DuckDB text."""
    names = ", ".join(k.rsplit(" as ", 1)[1] for k in keys)
    return f"SELECT {names}, {value} FROM (SELECT *, {', '.join(render(keys, 'duckdb'))} FROM orders WHERE {where}) GROUP BY {names}"


def house_prices_sql() -> str:
    return " UNION ALL ".join(observed_sql(keys[:-1], HPI_VALUE, keys[-1]) for keys in HPI_LEVELS)
