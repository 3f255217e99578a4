"""Person-periods, and the distributed fit against NumPy on the given tables."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from mortar.operators.hazard import (
    EXITS, FEATURES, calibration, coefficients, fit_hazard, held_out, life_table, person_periods, with_features, with_hazard,
)
from mortar.plans.analytics import _periods

from conftest import SF001


def test_person_periods_end_with_the_first_exit(spark):
    def d(m):
        return dt.date(2000, m, 1)
    rows = [("a", d(1), 0, None, "N"), ("a", d(2), 6, None, "N"), ("a", d(3), 0, "01", "N"),  # default, later months go
            ("b", d(1), 0, None, "N"), ("b", d(2), None, None, None),                         # censored
            ("c", d(1), 7, "01", "Y"),                                                        # default comes first
            ("d", d(1), 0, "01", "Y"), ("e", d(1), -2, "01", "N"), ("f", d(1), 1, "09", "N"), ("g", d(1), 1, "06", "N"),
            (None, d(1), 0, None, "N"), ("h", None, 0, None, "N")]
    df = spark.createDataFrame(rows, "LOAN_ID string, ACT_DTE date, DLQ_STATUS int, ZB_CODE string, MOD_FLAG string")
    got = sorted((r.LOAN_ID, r.ACT_DTE.month, r.EXIT) for r in person_periods(df).collect())
    assert got == [("a", 1, 0), ("a", 2, 1), ("b", 1, 0), ("b", 2, 0), ("c", 1, 1), ("d", 1, 2), ("e", 1, 3), ("f", 1, 1),
                   ("g", 1, 0)]
    assert person_periods(df.where("false")).count() == 0


def newton(x, y, exits):
    """The same model by a plain Newton on the whole matrix, Hessian by outer products row by row."""
    k, f = len(exits), x.shape[1]
    beta = np.zeros(k * f)
    onehot = np.stack([(y == e).astype(float) for e in exits], 1)
    for _ in range(60):
        e = np.exp(x @ beta.reshape(k, f).T)
        p = e / (1 + e.sum(1, keepdims=True))
        g = np.einsum("nk,nf->kf", onehot - p, x).ravel() - 1e-6 * beta
        h = np.einsum("nab,nf,ng->afbg", np.einsum("na,ab->nab", p, np.eye(k)) - np.einsum("na,nb->nab", p, p), x, x)
        beta = beta + np.linalg.solve(h.reshape(k * f, k * f) + 1e-6 * np.eye(k * f), g)
    return beta.reshape(k, f)


@pytest.fixture(scope="module")
def periods(spark):
    return with_features(_periods(spark, SF001))


def test_fit_equals_numpy(spark, periods):
    train = periods.where(~held_out())
    fit = fit_hazard(train.repartition(5))
    rows = train.select("EXIT", *FEATURES).toPandas()
    exits = sorted(set(rows.EXIT) - {0})
    assert fit.exits == tuple(exits) and fit.rows == len(rows) and len(rows) > 500
    want = newton(rows[list(FEATURES)].to_numpy(float), rows.EXIT.to_numpy(), exits)
    steady = np.abs(want) < 8  # an exit that hardly happens has a coefficient without a bound
    assert np.allclose(fit.coef[steady], want[steady], atol=1e-4)
    table = coefficients(spark, fit)
    assert table.count() == len(exits) * len(FEATURES)
    assert {r.EXIT for r in table.collect()} <= set(EXITS)


def test_rates_add_up_and_held_out_loans_are_calibrated(spark, periods):
    fit = fit_hazard(periods.where(~held_out()))
    scored = with_hazard(periods.where(held_out()), fit)
    total = F.col("P_DEFAULT") + F.col("P_MODIFIED") + F.col("P_PREPAID")
    assert scored.where((total < 0) | (total > 1)).count() == 0
    # on the loans it was fitted to, a model with a constant has the observed mean
    own = with_hazard(periods.where(~held_out()), fit).agg(
        F.avg("P_DEFAULT").alias("p"), F.avg((F.col("EXIT") == 1).cast("double")).alias("o")).first()
    assert own.p == pytest.approx(own.o, abs=1e-5)
    bins = calibration(scored).collect()
    n = sum(r.N for r in bins if r.EXIT == "DEFAULT")
    assert n == scored.count() and all(0 <= r.PREDICTED <= 1 and 0 <= r.OBSERVED <= 1 for r in bins)
    off = sum(r.N * (r.PREDICTED - r.OBSERVED) for r in bins if r.EXIT == "DEFAULT") / n
    assert abs(off) < 0.05


def test_without_exits_or_rows(spark, periods):
    none = fit_hazard(periods.withColumn("EXIT", F.lit(0)))
    assert none.exits == () and with_hazard(periods, none).agg(F.max("P_DEFAULT")).first()[0] == 0.0
    assert fit_hazard(periods.where("false")).rows == 0
    assert life_table(periods).agg(F.sum("AT_RISK")).first()[0] == periods.count()
