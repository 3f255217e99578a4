"""Default and prepayment hazard: person-periods, competing exits, a distributed fit.

``person_periods`` turns the monthly panel into one row per loan and month at
risk: months up to and with a loan's first exit, or all its months if it has
none (censored).  ``fit_hazard`` fits a multinomial logit of the exit of the
month (none, or one of the competing exits) by Newton's method: every step is
one pass in which each task sums its rows' gradient and Hessian; their sum, a
vector bounded by the number of coefficients, comes to the driver.  Scoring is
column expressions.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from ..session import remove_path, scratch_path

# Executors need only NumPy and pyarrow, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# --- fixed values: exits in order of precedence, and zero balance codes -----------
EXITS = ("DEFAULT", "MODIFIED", "PREPAID")
PREPAID_CODES = ("01",)
CREDIT_CODES = ("02", "03", "09")
# --- end of fixed values ------------------------------------------------------------

# Months past due that count as default (six: 180 days).
DEFAULT_STATUS = 6
FEATURES = ("BASE", "AGE", "AGE_SQ", "LATE", "SERIOUS", "INCENTIVE", "LTV")
HELD_OUT = (5, 0)  # held-out loans: crc32(LOAN_ID) mod 5 = 0


def exit_of(default_status: int = DEFAULT_STATUS) -> Column:
    """0 for a month without exit, else 1 + the exit's place in ``EXITS``."""
    code = F.col("ZB_CODE")
    default = (F.col("DLQ_STATUS") >= default_status) | code.isin(*CREDIT_CODES)
    return (F.when(default, 1).when(F.col("MOD_FLAG") == "Y", 2).when(code.isin(*PREPAID_CODES), 3).otherwise(0))


def person_periods(panel: DataFrame, default_status: int = DEFAULT_STATUS) -> DataFrame:
    """``panel`` rows at risk with EXIT: months up to the loan's first exit.

    The first exit of a loan is a partial aggregate, so a loan of very many
    rows is not gathered.  Rows without a loan or a month are left out; a
    month reported twice is two rows.
    """
    rows = panel.where(F.col("LOAN_ID").isNotNull() & F.col("ACT_DTE").isNotNull()).withColumn(
        "EXIT", exit_of(default_status).cast("int"))
    first = rows.where(F.col("EXIT") > 0).groupBy(F.col("LOAN_ID").alias("_lid")).agg(F.min("ACT_DTE").alias("_end"))
    return rows.join(first, F.col("LOAN_ID") == F.col("_lid"), "left").where(
        F.col("_end").isNull() | (F.col("ACT_DTE") <= F.col("_end"))).drop("_lid", "_end")


def life_table(periods: DataFrame) -> DataFrame:
    """Per age: loans at risk, exits of each kind and their rates."""
    counts = [F.count(F.when(F.col("EXIT") == k, 1)).alias(f"N_{name}") for k, name in enumerate(EXITS, 1)]
    table = periods.groupBy("LOAN_AGE").agg(F.count(F.lit(1)).alias("AT_RISK"), *counts)
    return table.select("*", *[(F.col(f"N_{n}") / F.col("AT_RISK")).alias(f"{n}_RATE") for n in EXITS])


def with_features(periods: DataFrame) -> DataFrame:
    """The default covariates, all known before the month; an unknown one counts as 0.

    Expects ``DLQ_LAG`` (see ``enrich_panel``), ``INCENTIVE`` (see
    ``rate_incentive``) and ``OLTV``.
    """
    def known(c) -> Column:
        return F.coalesce(c.cast("double"), F.lit(0.0))
    age = known(F.col("LOAN_AGE")) / 12
    return periods.withColumns({
        "BASE": F.lit(1.0), "AGE": age, "AGE_SQ": age * age, "LATE": known(F.col("DLQ_LAG") > 0),
        "SERIOUS": known(F.col("DLQ_LAG") > 2), "INCENTIVE": known(F.col("INCENTIVE")), "LTV": known(F.col("OLTV")) / 100})


def held_out(loan: str = "LOAN_ID") -> Column:
    """Loans kept for calibration, whole."""
    return F.pmod(F.crc32(F.col(loan)), F.lit(HELD_OUT[0])) == HELD_OUT[1]


@dataclass(frozen=True)
class HazardFit:
    """Coefficients (exit by feature) with standard errors."""

    exits: tuple[int, ...]
    features: tuple[str, ...]
    coef: np.ndarray
    error: np.ndarray
    log_likelihood: float
    steps: int
    rows: int


def _sums(x: np.ndarray, exit_: np.ndarray, exits: Sequence[int], beta: np.ndarray) -> np.ndarray:
    """Log-likelihood, rows, gradient and Hessian (row by row) of some rows, as one vector."""
    score = np.hstack([np.zeros((len(x), 1)), x @ beta.T])
    top = score.max(1, keepdims=True)
    total = top + np.log(np.exp(score - top).sum(1, keepdims=True))
    p = np.exp(score - total)[:, 1:]
    y = (exit_[:, None] == np.asarray(exits)[None, :]).astype(float)
    chosen = np.where(y.any(1), (y * score[:, 1:]).sum(1), 0.0)
    k, f = beta.shape
    hessian = np.empty((k, f, k, f))
    for a in range(k):
        for b in range(k):
            weight = p[:, a] * ((a == b) - p[:, b])
            hessian[a, :, b, :] = (x * weight[:, None]).T @ x
    return np.concatenate([[(chosen - total[:, 0]).sum(), len(x)], ((y - p).T @ x).ravel(), hessian.ravel()])


def _partial_sums(batches: Iterator, exits: Sequence[int], beta: np.ndarray):
    """One row a coefficient, pair of them and total: this task's sums."""
    import pyarrow as pa

    sums = None
    for batch in batches:
        if batch.num_rows:
            x = np.stack([batch.column(i + 1).to_numpy(zero_copy_only=False) for i in range(beta.shape[1])], 1)
            part = _sums(x, batch.column(0).to_numpy(zero_copy_only=False), exits, beta)
            sums = part if sums is None else sums + part
    if sums is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums), dtype=np.int32)), pa.array(sums)],
                                         names=["at", "part"])


def _pass(rows: DataFrame, exits: Sequence[int], beta: np.ndarray) -> tuple[float, int, np.ndarray, np.ndarray]:
    parts = rows.mapInArrow(partial(_partial_sums, exits=tuple(exits), beta=beta), "at int, part double")
    sums = np.zeros(2 + beta.size + beta.size ** 2)
    for r in parts.groupBy("at").agg(F.sum("part").alias("total")).collect():
        sums[r["at"]] = r["total"]
    return sums[0], int(sums[1]), sums[2:2 + beta.size], sums[2 + beta.size:].reshape(beta.size, beta.size)


def fit_hazard(periods: DataFrame, features: Sequence[str] = FEATURES, ridge: float = 1e-6, tolerance: float = 1e-10,
               max_steps: int = 50) -> HazardFit:
    """Multinomial logit of EXIT on ``features`` by Newton steps (halved when the likelihood falls).

    ``ridge`` keeps coefficients finite where data do not (a feature without
    variation); an exit that never happens has no coefficients, its hazard is 0.
    The rows are written once and read by every step.
    """
    spark = periods.sparkSession
    path = scratch_path(spark, "hazard")
    periods.select("EXIT", *[F.col(f).cast("double").alias(f) for f in features]).write.parquet(path)
    rows = spark.read.parquet(path)
    exits = [r.EXIT for r in rows.where("EXIT > 0").groupBy("EXIT").count().orderBy("EXIT").collect()]
    beta = np.zeros((len(exits), len(features)))
    steps = 0
    value, n, gradient, hessian = _pass(rows, exits, beta)
    while exits and steps < max_steps:
        goal = gradient - ridge * beta.ravel()
        move = np.linalg.solve(hessian + ridge * np.eye(beta.size), goal).reshape(beta.shape)
        if float(goal @ move.ravel()) < tolerance * max(1, n):  # the likelihood can rise no further
            break
        penal = value - ridge / 2 * (beta ** 2).sum()
        for _ in range(30):
            steps += 1
            tried = beta + move
            result = _pass(rows, exits, tried)
            if result[0] - ridge / 2 * (tried ** 2).sum() >= penal - 1e-12 * abs(penal):
                break
            move = move / 2
        beta, (value, n, gradient, hessian) = tried, result
    error = np.sqrt(np.diag(np.linalg.inv(hessian + ridge * np.eye(beta.size)))).reshape(beta.shape) if exits else beta
    remove_path(spark, path)
    return HazardFit(tuple(exits), tuple(features), beta, error, value, steps, n)


def coefficients(spark, fit: HazardFit) -> DataFrame:
    """(EXIT, FEATURE, COEF, STD_ERROR): the fit as a table."""
    rows = [(EXITS[e - 1], f, float(fit.coef[i, j]), float(fit.error[i, j]))
            for i, e in enumerate(fit.exits) for j, f in enumerate(fit.features)]
    return spark.createDataFrame(rows, "EXIT string, FEATURE string, COEF double, STD_ERROR double")


def with_hazard(periods: DataFrame, fit: HazardFit) -> DataFrame:
    """``periods`` with the month's probability of every exit (``P_<exit>``), as expressions."""
    def score(i: int) -> Column:
        terms = [F.col(f).cast("double") * F.lit(float(c)) for f, c in zip(fit.features, fit.coef[i])]
        return sum(terms[1:], terms[0])
    scores = {f"_s{i}": score(i) for i in range(len(fit.exits))}
    scored = periods.withColumns(scores) if scores else periods
    top = F.greatest(F.lit(0.0), *[F.col(s) for s in scores], F.lit(0.0))
    weights = [F.exp(F.col(s) - top) for s in scores]
    total = sum(weights, F.exp(-top))
    by_exit = {e: w / total for e, w in zip(fit.exits, weights)}
    return scored.withColumns({
        f"P_{name}": by_exit.get(k, F.lit(0.0)) for k, name in enumerate(EXITS, 1)}).drop(*scores)


def calibration(scored: DataFrame, bins: int = 10) -> DataFrame:
    """(EXIT, BIN, N, PREDICTED, OBSERVED): mean predicted and observed rates by predicted risk.

    Bin borders are approximate quantiles of the predicted rate (a bounded sketch).
    """
    parts = None
    for k, name in enumerate(EXITS, 1):
        p = F.col(f"P_{name}")
        borders = scored.select(F.percentile_approx(f"P_{name}", [i / bins for i in range(1, bins)], 10_000)).first()[0] or []
        at = sum([(p > b).cast("int") for b in sorted(set(borders))], F.lit(0))
        part = scored.groupBy(F.lit(name).alias("EXIT"), at.alias("BIN")).agg(
            F.count(F.lit(1)).alias("N"), F.avg(p).alias("PREDICTED"),
            F.avg((F.col("EXIT") == k).cast("double")).alias("OBSERVED"))
        parts = part if parts is None else parts.unionByName(part)
    return parts
