"""Queries of the planned analytics: adjustable rates, incentive, property value, calendar frames, hazard.

Same rules as ``queries``: whole tables, and a DuckDB oracle that computes the
result another way (month by month where the engine has a closed form).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.cleaning import round_half_up
from ..functions.months import month_date
from ..operators.arm import arm_resets, arm_schedule, index_series, rejected_arms
from ..operators.calendar import CALENDAR_COLUMNS, enrich_calendar
from ..operators.hazard import (
    EXITS, calibration, coefficients, fit_hazard, held_out, life_table, person_periods, with_features, with_hazard,
)
from ..operators.market import filled_prices, mark_to_market, rate_incentive
from ..operators.profile import merge_profiles, profile_report, tape_profile
from ..operators.schedule import one_row_per_loan
from ..operators.series import rejected_series
from ..schema import FNMA
from ..session import scratch_path
from ..sinks.parquet import save_parquet
from ..sources import market
from ..sources.fixtures import fnma_acquisition, fnma_performance, render
from ..sources.text import write_tape
from ..streaming.lookback import ingest_lookback
from .loan_level import LoanLevel, build
from .queries import MONTH_COUNT, SPLIT_THRESHOLD, _long_sql, present, register
from .sql import create_functions



def _level(spark, sf) -> LoanLevel:
    return build(fnma_performance(spark, sf), fnma_acquisition(spark, sf), FNMA)


# --- adjustable-rate schedules ---------------------------------------------------

_ARM_CTES = f"""
armt AS (SELECT {', '.join(render(market.ARM_EXPRS, 'duckdb'))} FROM orders),
rates AS ({market.observed_sql(market.INDEX_KEYS, market.INDEX_VALUE)})"""


def _payment_sql(p: str, rate: str, k: str) -> str:
    return (f"(CASE WHEN {rate} = 0 THEN {p} / {k} "
            f"ELSE {p} * (({rate} / 1200.0) / (1 - pow(1 + {rate} / 1200.0, -({k})))) END)")


_FIN = ("CASE WHEN m + 1 >= ORIG_TRM THEN 0.0 WHEN m < IO_MONTHS THEN beg "
        "WHEN beg - (pay - beg * (rate / 1200.0)) < 0.005 THEN 0.0 ELSE beg - (pay - beg * (rate / 1200.0)) END")
_EVENT = ("m = 0 OR reset OR (PAY_EVERY > 0 AND m % PAY_EVERY = 0) OR (RECAST_EVERY > 0 AND m % RECAST_EVERY = 0) "
          "OR (IO_MONTHS > 0 AND m = IO_MONTHS)")
# The contract month by month: rate, payment and balance of each from the month before.
_ARM_MONTHS = f"""(
WITH RECURSIVE idx AS (SELECT INDEX_NAME, year(MONTH) * 12 + month(MONTH) - 1 AS mno, VALUE FROM rates),
armi AS (
  SELECT armt.*, last_m, year(FRST_DTE) * 12 + month(FRST_DTE) - 1 AS start_m FROM armt
  LEFT JOIN (SELECT INDEX_NAME, max(mno) AS last_m FROM idx GROUP BY INDEX_NAME) USING (INDEX_NAME)),
rec(LOAN_ID, m, reset, event, idx, full_rt, rate, pay, beg, fin) AS (
  SELECT LOAN_ID, 0, false, true, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), rate, pay, beg, {_FIN}
  FROM (SELECT *, 0 AS m, ORIG_RT AS rate, ORIG_AMT AS beg,
               CASE WHEN IO_MONTHS > 0 THEN ORIG_AMT * (ORIG_RT / 1200.0) ELSE {_payment_sql('ORIG_AMT', 'ORIG_RT', 'ORIG_TRM')} END AS pay
        FROM armi)
  UNION ALL
  SELECT LOAN_ID, m, reset, {_EVENT}, idx, full_rt, rate, pay, beg, {_FIN}
  FROM (
    SELECT *, CASE WHEN NOT due THEN pay0 WHEN PAY_CAP IS NULL OR recast OR hit THEN whole
                   ELSE least(greatest(whole, pay0 * (1.0 - PAY_CAP)), pay0 * (1.0 + PAY_CAP)) END AS pay
    FROM (
      SELECT *, hit OR recast OR m = IO_MONTHS OR CASE WHEN PAY_EVERY > 0 THEN m % PAY_EVERY = 0 ELSE reset END AS due,
             CASE WHEN m < IO_MONTHS THEN beg * (rate / 1200.0) ELSE {_payment_sql('beg', 'rate', '(ORIG_TRM - m)')} END AS whole
      FROM (
        SELECT *, CASE WHEN NOT reset THEN rate0 WHEN ARM_TYPE = 'stepped' THEN full_rt
                       ELSE least(greatest(full_rt, rate0 - cap, coalesce(RATE_FLOOR, 0.0)), rate0 + cap, ORIG_RT + LIFE_CAP)
                  END AS rate
        FROM (
          SELECT *, CASE WHEN NOT reset THEN NULL WHEN ARM_TYPE = 'stepped'
                         THEN ORIG_RT + STEP_SIZE * least(STEPS, (m - FIRST_RESET) // RESET_EVERY + 1)
                         ELSE floor((idx + MARGIN) / 0.125 + 0.5) * 0.125 END AS full_rt,
                 CASE WHEN m = FIRST_RESET THEN INIT_CAP ELSE PERIODIC_CAP END AS cap
          FROM (
            SELECT a.*, r.m + 1 AS m, r.rate AS rate0, r.pay AS pay0, r.fin AS beg,
                   r.m + 1 >= FIRST_RESET AND (r.m + 1 - FIRST_RESET) % RESET_EVERY = 0 AS reset,
                   coalesce(RECAST_EVERY > 0 AND (r.m + 1) % RECAST_EVERY = 0, false) AS recast,
                   coalesce(r.fin >= NEG_LIMIT * ORIG_AMT, false) AS hit,
                   CASE WHEN r.m + 1 >= FIRST_RESET AND (r.m + 1 - FIRST_RESET) % RESET_EVERY = 0 THEN v.VALUE END AS idx
            FROM rec r JOIN armi a USING (LOAN_ID)
            LEFT JOIN idx v ON v.INDEX_NAME = a.INDEX_NAME AND v.mno = least(last_m, start_m + r.m)
            WHERE r.fin > 0 AND r.m + 1 < ORIG_TRM))))))
SELECT * FROM rec JOIN armi USING (LOAN_ID))"""


def _money(**names: str) -> str:
    return ", ".join(f"floor(({e}) * 100 + 0.5) / 100 + 0.0 AS {n}" for n, e in names.items())


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: round_half_up(c, 2) + F.lit(0.0) for c in names})


def _resets(spark, sf) -> DataFrame:
    return arm_resets(market.arm_terms(spark, sf), index_series(market.index_rates(spark, sf)))


@register("arm_resets", f"""
, {_ARM_CTES.strip()}
SELECT LOAN_ID, ARM_TYPE, CAST(row_number() OVER w - 1 AS INTEGER) AS PERIOD, m AS MONTH, idx AS INDEX_RT, full_rt AS FULL_RT,
       rate AS RATE, {_money(PAYMENT='pay', BEG_BAL='beg', END_BAL='coalesce(lead(beg) OVER w, 0.0)')},
       CASE WHEN reset AND rate < full_rt THEN 'cap' WHEN reset AND rate > full_rt THEN 'floor' END AS CAP_HIT
FROM {_ARM_MONTHS} WHERE event WINDOW w AS (PARTITION BY LOAN_ID ORDER BY m)
""")
def arm_resets_q(spark, sf):
    """The table of resets of every adjustable loan, all four types."""
    return _rounded(_resets(spark, sf), "PAYMENT", "BEG_BAL", "END_BAL").select(
        "LOAN_ID", "ARM_TYPE", "PERIOD", "MONTH", "INDEX_RT", "FULL_RT", "RATE", "PAYMENT", "BEG_BAL", "END_BAL", "CAP_HIT")


@register("arm_schedule", f"""
, {_ARM_CTES.strip()}
SELECT LOAN_ID, CAST(m + 1 AS INTEGER) AS PMT_NO, rate AS RATE,
       {_money(BEG_BAL='beg', PAYMENT='beg * (rate / 1200.0) + (beg - fin)', PRINCIPAL='beg - fin',
               INTEREST='beg * (rate / 1200.0)', END_BAL='fin')} FROM {_ARM_MONTHS}
""")
def arm_schedule_q(spark, sf):
    """Every payment of every adjustable loan."""
    return _rounded(arm_schedule(_resets(spark, sf)), "BEG_BAL", "PAYMENT", "PRINCIPAL", "INTEREST", "END_BAL")


# Terms and series spoilt by rule.
_BAD_ARMS = {
    "MARGIN": "CASE WHEN CAST(LOAN_ID AS BIGINT) % 37 = 0 THEN NULL ELSE MARGIN END",
    "FRST_DTE": "CASE WHEN CAST(LOAN_ID AS BIGINT) % 41 = 0 THEN NULL ELSE FRST_DTE END",
    "INDEX_NAME": "CASE WHEN CAST(LOAN_ID AS BIGINT) % 43 = 0 THEN 'NONE' WHEN CAST(LOAN_ID AS BIGINT) % 11 = 0 THEN 'SOFR' "
                  "ELSE INDEX_NAME END",
    "RESET_EVERY": "CASE WHEN CAST(LOAN_ID AS BIGINT) % 47 = 0 THEN NULL ELSE RESET_EVERY END",
    "ARM_TYPE": "CASE WHEN CAST(LOAN_ID AS BIGINT) % 53 = 0 THEN NULL ELSE ARM_TYPE END",
    "ORIG_TRM": "CASE WHEN CAST(LOAN_ID AS BIGINT) % 59 = 0 THEN 100000000 ELSE ORIG_TRM END",
}
# LIBOR lacks a month, COFI has a month without a number, CMT1 two values for one; SOFR is CMT1 from 1997 on.
_BAD_RATES = """
SELECT INDEX_NAME, MONTH, VALUE FROM rates WHERE NOT (INDEX_NAME = 'LIBOR' AND MONTH = DATE '1999-06-01')
UNION ALL SELECT 'COFI', DATE '1998-03-01', CAST(NULL AS DOUBLE)
UNION ALL SELECT INDEX_NAME, MONTH, VALUE + 1 FROM rates WHERE INDEX_NAME = 'CMT1' AND MONTH = DATE '2000-01-01'
UNION ALL SELECT 'SOFR', MONTH, VALUE FROM rates WHERE INDEX_NAME = 'CMT1' AND MONTH >= DATE '1997-01-01'"""
_BAD_SERIES_SQL = f"""
, {_ARM_CTES.strip()}, bad AS ({_BAD_RATES}),
monthly AS (SELECT INDEX_NAME, MONTH, min(VALUE) AS lo, max(VALUE) AS hi, count(*) - count(VALUE) AS empty FROM bad GROUP BY ALL),
judged AS (
  SELECT INDEX_NAME, min(MONTH) AS FIRST_DTE, max(MONTH) AS LAST_DTE,
         CASE WHEN sum(empty) > 0 THEN 'month without a number' WHEN bool_or(lo <> hi) THEN 'two values for a month'
              WHEN count(*) <> date_diff('month', min(MONTH), max(MONTH)) + 1 THEN 'month missing' END AS REASON
  FROM monthly GROUP BY INDEX_NAME),
arms AS (SELECT * REPLACE ({', '.join(f'{e} AS {c}' for c, e in _BAD_ARMS.items())}) FROM armt)"""


def _spoilt_arms(spark, sf):
    arms = market.arm_terms(spark, sf)
    rates = market.index_rates(spark, sf)
    bad = arms.select(*[F.expr(_BAD_ARMS[c]).cast(arms.schema[c].dataType).alias(c) if c in _BAD_ARMS else F.col(c)
                        for c in arms.columns])
    return bad, index_series(spark.sql(_BAD_RATES.replace("FROM rates", "FROM {rates}"), rates=rates))


@register("arm_rejected_series", f"{_BAD_SERIES_SQL} SELECT * FROM judged WHERE REASON IS NOT NULL")
def arm_rejected_series_q(spark, sf):
    return rejected_series(_spoilt_arms(spark, sf)[1], "INDEX_NAME")


@register("arm_rejected", f"""{_BAD_SERIES_SQL}
SELECT * FROM (
  SELECT LOAN_ID, ARM_TYPE, arms.INDEX_NAME,
         CASE WHEN ORIG_TRM > 1200 THEN 'term too long' WHEN ARM_TYPE IS NULL THEN 'no type'
              WHEN RESET_EVERY IS NULL THEN 'no reset period'
              WHEN ARM_TYPE = 'stepped' OR FIRST_RESET >= ORIG_TRM THEN NULL
              WHEN MARGIN IS NULL THEN 'no margin' WHEN FRST_DTE IS NULL THEN 'no first payment date'
              WHEN FIRST_DTE IS NULL THEN 'no such index' WHEN REASON IS NOT NULL THEN 'index: ' || REASON
              WHEN FRST_DTE + to_months(FIRST_RESET - 1) < FIRST_DTE THEN 'index starts too late' END AS REASON
  FROM arms LEFT JOIN judged ON judged.INDEX_NAME = arms.INDEX_NAME) WHERE REASON IS NOT NULL
""")
def arm_rejected_q(spark, sf):
    """Adjustable loans without a schedule: spoilt terms and corrupt series, with the reason."""
    return rejected_arms(*_spoilt_arms(spark, sf))


# --- rate incentive ------------------------------------------------------------------

_QUOTES = f"quotes AS ({market.observed_sql(market.QUOTE_KEYS, market.QUOTE_VALUE)})"
_BUCKET = ("CASE WHEN ORIG_TRM <= 0 THEN NULL WHEN ORIG_TRM <= 120 THEN 120 WHEN ORIG_TRM <= 180 THEN 180 "
           "WHEN ORIG_TRM <= 240 THEN 240 WHEN ORIG_TRM > 240 THEN 360 END")
_INCENTIVE_SQL = f"""
, {_QUOTES},
p AS (SELECT perf.*, CAST({_BUCKET} AS INTEGER) AS TERM_BUCKET FROM perf LEFT JOIN loans USING (LOAN_ID))
SELECT LOAN_ID, ACT_DTE, LOAN_AGE, LAST_RT, p.TERM_BUCKET, QUOTE_DTE, MKT_RT, LAST_RT - MKT_RT AS INCENTIVE,
       LAST_RT / MKT_RT AS INCENTIVE_RATIO
FROM p ASOF LEFT JOIN quotes ON p.TERM_BUCKET = quotes.TERM_BUCKET AND p.ACT_DTE >= quotes.QUOTE_DTE"""


def _incentive(spark, sf, **how) -> DataFrame:
    lvl = _level(spark, sf)
    return rate_incentive(lvl.perf_base, lvl.loans, market.rate_quotes(spark, sf), **how).select(
        "LOAN_ID", "ACT_DTE", "LOAN_AGE", "LAST_RT", "TERM_BUCKET", "QUOTE_DTE", "MKT_RT", "INCENTIVE", "INCENTIVE_RATIO")


register("rate_incentive", _INCENTIVE_SQL)(lambda spark, sf: _incentive(spark, sf))
# Every bucket counts as hot: filled task by task.
register("rate_incentive_split", _INCENTIVE_SQL)(lambda spark, sf: _incentive(spark, sf, hot_threshold=10))

# --- mark-to-market loan-to-value ------------------------------------------------------

_HPI_SQL = f"""
, hpi AS ({market.house_prices_sql()}),
known AS (SELECT LEVEL, REGION, year(MONTH) * 12 + month(MONTH) - 1 AS m, HPI FROM hpi),
spans AS (SELECT *, lead(m) OVER w AS to_m, lead(HPI) OVER w AS to_hpi FROM known WINDOW w AS (PARTITION BY LEVEL, REGION ORDER BY m)),
months AS (SELECT *, unnest(range(m, coalesce(to_m, m + 1))) AS mm FROM spans),
prices AS (
  SELECT LEVEL, REGION, mm AS m, mm > m AS INTERPOLATED,
         CASE WHEN mm = m THEN HPI ELSE HPI + (to_hpi - HPI) * (mm - m) / (to_m - m) END AS HPI FROM months)"""


@register("house_price_months", f"""{_HPI_SQL}
SELECT LEVEL, REGION, make_date(m // 12, m % 12 + 1, 1) AS MONTH, HPI, INTERPOLATED FROM prices""")
def house_price_months_q(spark, sf):
    """House prices without gaps: missing months interpolated between a region's first and last value."""
    return filled_prices(market.house_prices(spark, sf)).select(
        "LEVEL", "REGION", month_date("_m").alias("MONTH"), "HPI", "INTERPOLATED")


@register("mark_to_market", f"""{_HPI_SQL},
p AS (
  SELECT perf.*, ORIG_AMT, OLTV, STATE, ZIP_3, year(ACT_DTE) * 12 + month(ACT_DTE) - 1 AS m1,
         year(ORIG_DTE) * 12 + month(ORIG_DTE) - 1 AS m0 FROM perf LEFT JOIN loans USING (LOAN_ID)),
g AS (
  SELECT p.*, z1.HPI / z0.HPI AS z, s1.HPI / s0.HPI AS s, n1.HPI / n0.HPI AS n FROM p
  LEFT JOIN prices z0 ON z0.LEVEL = 'ZIP3' AND z0.REGION = ZIP_3 AND z0.m = m0
  LEFT JOIN prices z1 ON z1.LEVEL = 'ZIP3' AND z1.REGION = ZIP_3 AND z1.m = m1
  LEFT JOIN prices s0 ON s0.LEVEL = 'STATE' AND s0.REGION = STATE AND s0.m = m0
  LEFT JOIN prices s1 ON s1.LEVEL = 'STATE' AND s1.REGION = STATE AND s1.m = m1
  LEFT JOIN prices n0 ON n0.LEVEL = 'NATION' AND n0.m = m0
  LEFT JOIN prices n1 ON n1.LEVEL = 'NATION' AND n1.m = m1)
SELECT LOAN_ID, ACT_DTE, LOAN_AGE, LAST_UPB,
       CASE WHEN z IS NOT NULL THEN 'ZIP3' WHEN s IS NOT NULL THEN 'STATE' WHEN n IS NOT NULL THEN 'NATION' END AS HPI_LEVEL,
       round(coalesce(z, s, n), 6) + 0.0 AS HPI_GROWTH,
       round(CASE WHEN OLTV > 0 THEN 100.0 * LAST_UPB / (ORIG_AMT / (OLTV / 100) * coalesce(z, s, n)) END, 6) + 0.0 AS MTM_LTV
FROM g""")
def mark_to_market_q(spark, sf):
    """Mark-to-market LTV of every month; HPI_LEVEL tells where a coarser region stood in."""
    lvl = _level(spark, sf)
    out = mark_to_market(lvl.perf_base, lvl.loans, market.house_prices(spark, sf))
    return out.select("LOAN_ID", "ACT_DTE", "LOAN_AGE", "LAST_UPB", "HPI_LEVEL", F.round("HPI_GROWTH", 6).alias("HPI_GROWTH"),
                      F.round("MTM_LTV", 6).alias("MTM_LTV"))


# --- calendar frames -------------------------------------------------------------------

# Some months are missing, some are reported a second time with other values.
_UNEVEN_SQL = """(SELECT * FROM perf WHERE LOAN_AGE % 7 <> 3 UNION ALL
  SELECT * REPLACE (DLQ_STATUS + 1 AS DLQ_STATUS, 'Z' AS MOD_FLAG) FROM perf WHERE LOAN_AGE % 5 = 2)"""


def _range(c: str, first: str, last: str) -> str:
    return f"max({c}) OVER (PARTITION BY LOAN_ID ORDER BY m RANGE BETWEEN {first} AND {last})"


def _slot(k: int) -> str:
    return f"coalesce(CAST({_range('DLQ_STATUS', f'{k} PRECEDING', f'{k} PRECEDING')} AS VARCHAR), '')"


_CALENDAR_SQL = f"""
SELECT LOAN_ID, ACT_DTE, LOAN_AGE, DLQ_STATUS,
       {_range('DLQ_STATUS', '1 PRECEDING', '1 PRECEDING')} AS DLQ_LAG_cal,
       {" || ',' || ".join(_slot(k) for k in range(12, 0, -1))} AS DLQ_LAGs12_cal,
       {_range('DLQ_STATUS', '1 FOLLOWING', '12 FOLLOWING')} AS DLQ_NEXT12MAX_cal,
       {_range('DLQ_STATUS', '1 FOLLOWING', '24 FOLLOWING')} AS DLQ_NEXT24MAX_cal,
       {_range('ZB_CODE', '1 FOLLOWING', '12 FOLLOWING')} AS ZBCODE_NEXT12_cal,
       {_range('ZB_CODE', '1 FOLLOWING', '24 FOLLOWING')} AS ZBCODE_NEXT24_cal,
       {_range('MOD_FLAG', '1 FOLLOWING', '12 FOLLOWING')} AS MOD_NEXT12_cal,
       {_range('MOD_FLAG', '1 FOLLOWING', '24 FOLLOWING')} AS MOD_NEXT24_cal
FROM (SELECT *, year(ACT_DTE) * 12 + month(ACT_DTE) AS m FROM {_UNEVEN_SQL})"""


def _calendar(spark, sf, **how) -> DataFrame:
    perf = _level(spark, sf).perf_base
    again = perf.where("LOAN_AGE % 5 = 2").withColumns({"DLQ_STATUS": F.col("DLQ_STATUS") + 1, "MOD_FLAG": F.lit("Z")})
    out = enrich_calendar(perf.where("LOAN_AGE % 7 <> 3").unionByName(again), **how)
    slots = F.array_join(F.transform("DLQ_LAGs12_cal", lambda s: F.coalesce(s.cast("string"), F.lit(""))), ",")
    return out.withColumn("DLQ_LAGs12_cal", slots).select("LOAN_ID", "ACT_DTE", "LOAN_AGE", "DLQ_STATUS", *CALENDAR_COLUMNS)


register("panel_calendar", _CALENDAR_SQL)(lambda spark, sf: _calendar(spark, sf))
register("panel_calendar_split", _CALENDAR_SQL)(lambda spark, sf: _calendar(spark, sf, hot_threshold=SPLIT_THRESHOLD))


# --- hazard ------------------------------------------------------------------------------

# The given panel's statuses end at five.
HAZARD_STATUS = 5
_PERIODS_SQL = f"""
, x AS (
  SELECT LOAN_ID, ACT_DTE, LOAN_AGE,
         CASE WHEN DLQ_STATUS >= {HAZARD_STATUS} OR ZB_CODE IN ('02', '03', '09') THEN 1 WHEN MOD_FLAG = 'Y' THEN 2
              WHEN ZB_CODE = '01' THEN 3 ELSE 0 END AS EXIT FROM perf),
periods AS (
  SELECT x.* FROM x LEFT JOIN (SELECT LOAN_ID, min(ACT_DTE) AS last FROM x WHERE EXIT > 0 GROUP BY LOAN_ID) USING (LOAN_ID)
  WHERE last IS NULL OR ACT_DTE <= last)"""


def _periods(spark, sf) -> DataFrame:
    lvl = _level(spark, sf)
    panel = rate_incentive(lvl.panel, lvl.loans, market.rate_quotes(spark, sf))
    ltv = one_row_per_loan(lvl.loans, "OLTV").withColumnRenamed("LOAN_ID", "_of")
    return person_periods(panel.join(ltv, panel["LOAN_ID"] == F.col("_of"), "left").drop("_of"), HAZARD_STATUS)


@register("hazard_periods", f"{_PERIODS_SQL} SELECT LOAN_ID, ACT_DTE, LOAN_AGE, EXIT FROM periods")
def hazard_periods_q(spark, sf):
    """Months at risk of every loan, with the month's exit."""
    return _periods(spark, sf).select("LOAN_ID", "ACT_DTE", "LOAN_AGE", "EXIT")


@register("hazard_life_table", f"{_PERIODS_SQL} SELECT LOAN_AGE, count(*) AS AT_RISK, " + ", ".join(
    f"count(*) FILTER (EXIT = {k}) AS N_{n}, count(*) FILTER (EXIT = {k}) / count(*) AS {n}_RATE"
    for k, n in enumerate(EXITS, 1)) + " FROM periods GROUP BY LOAN_AGE")
def hazard_life_table_q(spark, sf):
    return life_table(_periods(spark, sf))


@register("hazard_fit", None)
def hazard_fit_q(spark, sf):
    """Coefficients of the competing exits, fitted on the loans that are not held out."""
    fit = fit_hazard(with_features(_periods(spark, sf)).where(~held_out()))
    return coefficients(spark, fit).withColumns({c: F.round(c, 6) for c in ("COEF", "STD_ERROR")})


@register("hazard_calibration", None)
def hazard_calibration_q(spark, sf):
    """Predicted and observed exits of the held-out loans, by predicted risk."""
    rows = with_features(_periods(spark, sf))
    scored = with_hazard(rows.where(held_out()), fit_hazard(rows.where(~held_out())))
    return calibration(scored).withColumns({c: F.round(c, 6) for c in ("PREDICTED", "OBSERVED")})


# --- SQL functions -------------------------------------------------------------------------

@register("sql_schedule", _long_sql(0))
def sql_schedule_q(spark, sf):
    """The schedule as SQL text over a view: a table function of the catalog, called for every loan."""
    view = "loans_" + scratch_path(spark, "view").rsplit("-", 1)[-1]
    create_functions(spark)
    _level(spark, sf).loans.createOrReplaceTempView(view)
    return spark.sql(f"""
        SELECT LOAN_ID, LOAN_AGE, round(CASE WHEN LOAN_AGE = 0 THEN ORIG_AMT ELSE SCHD_UPB END, 2) AS SCHD_UPB
        FROM {view}, LATERAL loan_schedule(ORIG_AMT, ORIG_RT, ORIG_TRM,
                                           (SELECT least(max(ORIG_TRM), {MONTH_COUNT}) FROM {view})) s""")


@register("sql_scalars", """
SELECT LOAN_ID, CASE WHEN ORIG_CHN IN ('R', 'C') THEN 'R1' WHEN ORIG_CHN = 'B' THEN 'B1' ELSE ORIG_CHN END AS CHN_BUCKET,
       round(A, 3) + 0.0 AS PMT,
       CAST(CASE WHEN ORIG_TRM <= 120 THEN 120 WHEN ORIG_TRM <= 180 THEN 180 WHEN ORIG_TRM <= 240 THEN 240 ELSE 360 END AS INTEGER)
         AS TERM_BUCKET
FROM loans JOIN pay USING (LOAN_ID)""")
def sql_scalars_q(spark, sf):
    view = "loans_" + scratch_path(spark, "view").rsplit("-", 1)[-1]
    create_functions(spark)
    _level(spark, sf).loans.createOrReplaceTempView(view)
    return spark.sql(f"SELECT LOAN_ID, channel_bucket(ORIG_CHN) AS CHN_BUCKET, "
                     f"round(level_payment(ORIG_AMT, ORIG_RT, ORIG_TRM), 3) AS PMT, term_bucket(ORIG_TRM) AS TERM_BUCKET FROM {view}")


# --- look-back on the stream ----------------------------------------------------------------

@register("stream_lookback", """
SELECT LOAN_ID, ACT_DTE, LOAN_AGE, DLQ_LAG, coalesce(array_to_string(DLQ_LAGs12, ','), '') AS DLQ_LAGs12,
       MOD_FLAG = 'Y' AND count(*) FILTER (MOD_FLAG = 'Y') OVER w = 1 AS FIRST_MOD,
       coalesce(DLQ_STATUS > 2, false) AND count(*) FILTER (DLQ_STATUS > 2) OVER w = 1 AS FIRST_90D, false AS LATE
FROM panel WINDOW w AS (PARTITION BY LOAN_ID ORDER BY ACT_DTE, LOAN_AGE)""")
def stream_lookback_q(spark, sf):
    """Three landings of the tape, each a run of its own from the checkpoint; features come from state."""
    landing, target, ckpt = (scratch_path(spark, n) for n in ("landing", "lookback", "lookback-ckpt"))
    perf = fnma_performance(spark, sf)
    for part, rule in enumerate(("LOAN_AGE < 15", "LOAN_AGE BETWEEN 15 AND 39", "LOAN_AGE > 39")):
        write_tape(perf.where(rule), f"{landing}/part{part}", FNMA.performance)
        ingest_lookback(spark, landing + "/*", target, ckpt, FNMA)
    return present(spark.read.parquet(target).select(
        "LOAN_ID", "ACT_DTE", "LOAN_AGE", "DLQ_LAG", "DLQ_LAGs12", "FIRST_MOD", "FIRST_90D", "LATE"))


# --- tape profile ------------------------------------------------------------------------------

@register("tape_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS COLUMN, count(*) AS N_ROWS, count(*) - count({c}) AS N_NULLS FROM acq_raw" for c in FNMA.acquisition.names))
def tape_profile_q(spark, sf):
    """Exact counts of the loan tape's columns, merged from the profiles kept by vintage."""
    path = save_parquet(tape_profile(fnma_acquisition(spark, sf)), scratch_path(spark, "profile"))
    report = profile_report(merge_profiles(spark.read.parquet(path)))
    return report.select("COLUMN", "N_ROWS", "N_NULLS")
