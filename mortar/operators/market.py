"""Rate incentive and mark-to-market loan-to-value of the monthly panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.cleaning import col_of
from ..functions.months import month_number
from .asof import asof_join
from .schedule import one_row_per_loan
from .series import monthly_values
from .skew import MAX_BROADCAST_ROWS

# --- fixed values: terms (months) that market rates are quoted for ----------------
TERM_BUCKETS = (120, 180, 240, 360)
# --- fixed values: house price levels, the finest first ---------------------------
LEVELS = ("ZIP3", "STATE", "NATION")
NATION = "US"
# --- end of fixed values -----------------------------------------------------------


def term_bucket(term) -> Column:
    """The shortest quoted term that holds a loan's; longer ones take the last."""
    n = col_of(term)
    out = F.when(n.isNull() | (n <= 0), F.lit(None))
    for months in TERM_BUCKETS[:-1]:
        out = out.when(n <= months, months)
    return out.otherwise(TERM_BUCKETS[-1]).cast("int")


def rate_incentive(panel: DataFrame, loans: DataFrame, quotes: DataFrame, **how) -> DataFrame:
    """``panel`` with TERM_BUCKET, QUOTE_DTE, MKT_RT, INCENTIVE and INCENTIVE_RATIO.

    The market rate is the quote of the loan's term bucket in force at
    ``ACT_DTE`` (an as-of join).  INCENTIVE is the note rate less the market
    rate, its ratio the note rate over it.  Months before the first quote,
    and loans without one set of terms, have nulls.
    """
    terms = one_row_per_loan(loans, "ORIG_TRM").select(
        F.col("LOAN_ID").alias("_lid"), term_bucket("ORIG_TRM").alias("TERM_BUCKET"))
    rows = panel.join(terms, panel["LOAN_ID"] == F.col("_lid"), "left").drop("_lid")
    quoted = asof_join(rows, quotes, ["TERM_BUCKET"], "ACT_DTE", "QUOTE_DTE", ["MKT_RT"], **how)
    return quoted.withColumns({
        "INCENTIVE": F.col("LAST_RT") - F.col("MKT_RT"),
        "INCENTIVE_RATIO": F.try_divide(F.col("LAST_RT"), F.col("MKT_RT"))})


# --- house prices -----------------------------------------------------------------


def filled_prices(prices: DataFrame) -> DataFrame:
    """(LEVEL, REGION, _m, HPI, INTERPOLATED): every month from a region's first value to its last.

    Missing months are interpolated on a line between their neighbours; a
    month with several different values, or without a positive one, counts as
    missing.  Nothing is extended beyond the first and the last value.
    """
    known = monthly_values(prices.withColumn("_region", F.struct("LEVEL", "REGION")), "_region", "MONTH", "HPI").where(
        F.col("_reason").isNull() & (F.col("_value") > 0) & F.col("_region.REGION").isNotNull())
    w = Window.partitionBy("_region").orderBy("_m")
    spans = known.select("_region", "_m", "_value", F.lead("_m").over(w).alias("_next"), F.lead("_value").over(w).alias("_to"))
    months = spans.select("*", F.explode(F.sequence("_m", F.coalesce(F.col("_next") - 1, F.col("_m")))).alias("_at"))
    step = F.col("_at") - F.col("_m")
    return months.select(
        "_region.LEVEL", "_region.REGION", F.col("_at").alias("_m"),
        F.when(step == 0, F.col("_value")).otherwise(
            F.col("_value") + (F.col("_to") - F.col("_value")) * step / (F.col("_next") - F.col("_m"))).alias("HPI"),
        (step > 0).alias("INTERPOLATED"))


def region_prices(places: DataFrame, filled: DataFrame) -> DataFrame:
    """(STATE, ZIP_3, _m, ZIP3, STATE_HPI.., one column a level): one row per place and month.

    ``places`` are the distinct (STATE, ZIP_3) of the loans: each asks for its
    three regions in one join by equality.
    """
    keys = F.array(F.struct(F.lit("ZIP3").alias("LEVEL"), F.col("ZIP_3").alias("REGION")),
                   F.struct(F.lit("STATE").alias("LEVEL"), F.col("STATE").alias("REGION")),
                   F.struct(F.lit("NATION").alias("LEVEL"), F.lit(NATION).alias("REGION")))
    asked = places.select("STATE", "ZIP_3", F.inline(keys))
    return asked.join(filled.select("LEVEL", "REGION", "_m", "HPI"), ["LEVEL", "REGION"]).groupBy("STATE", "ZIP_3", "_m").agg(
        *[F.max(F.when(F.col("LEVEL") == level, F.col("HPI"))).alias(f"_{level}") for level in LEVELS])


def _at_month(rows: DataFrame, prices: DataFrame, month: Column, mark: str) -> DataFrame:
    """``rows`` with the three levels' prices of their place and ``month``, as ``_<level><mark>``."""
    named = prices.select(F.col("STATE").alias("_s"), F.col("ZIP_3").alias("_z"), F.col("_m").alias("_pm"),
                          *[F.col(f"_{level}").alias(f"_{level}{mark}") for level in LEVELS])
    same = F.col("STATE").eqNullSafe(F.col("_s")) & F.col("ZIP_3").eqNullSafe(F.col("_z")) & (month == F.col("_pm"))
    return rows.join(named, same, "left").drop("_s", "_z", "_pm")


def mark_to_market(panel: DataFrame, loans: DataFrame, prices: DataFrame) -> DataFrame:
    """``panel`` with HPI_LEVEL, HPI_GROWTH, MTM_VALUE and MTM_LTV.

    The value at origination (amount over LTV) grows with the house prices of
    the finest level that has both the origination and the reported month:
    ZIP3, else state, else nation.  HPI_LEVEL says which; it and the others
    are null where none has, and the value where the LTV is 0 or unknown.
    """
    loan = one_row_per_loan(loans, "ORIG_AMT", "OLTV", "ORIG_DTE", "STATE", "ZIP_3")
    places = loan.select("STATE", "ZIP_3").distinct()
    by_place = region_prices(places, filled_prices(prices))
    if by_place.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS:
        by_place = F.broadcast(by_place)
    begun = _at_month(loan, by_place, month_number("ORIG_DTE"), "0").select(
        F.col("LOAN_ID").alias("_lid"), F.struct("STATE", "ZIP_3").alias("_place"),
        F.when(F.col("OLTV") > 0, F.col("ORIG_AMT") / (F.col("OLTV") / 100)).alias("_value"),
        *[f"_{level}0" for level in LEVELS])
    rows = panel.select(F.struct(*panel.columns).alias("_row"), F.col("LOAN_ID").alias("_of"),
                        month_number("ACT_DTE").alias("_month"), F.col("LAST_UPB").alias("_upb"))
    joined = rows.join(begun, F.col("_of") == F.col("_lid"), "left").select("*", "_place.*")
    now = _at_month(joined, by_place, F.col("_month"), "1")
    growth = {level: F.col(f"_{level}1") / F.col(f"_{level}0") for level in LEVELS}
    level_of = F.coalesce(*[F.when(growth[level].isNotNull(), F.lit(level)) for level in LEVELS])
    grown = F.coalesce(*growth.values())
    value = F.col("_value") * grown
    return now.select("_row.*", level_of.alias("HPI_LEVEL"), grown.alias("HPI_GROWTH"), value.alias("MTM_VALUE"),
                      F.try_divide(F.lit(100.0) * F.col("_upb"), value).alias("MTM_LTV"))
