import datetime as dt

from pyspark.sql import functions as F

from mortar.operators.events import (
    first_modification, first_serious_delinquency, loan_events, zero_balance_events,
)
from mortar.operators.outcome import event_universe, loan_outcome, universe_outcome
from mortar.operators.panel import enrich_panel

SCHEMA = ("LOAN_ID string, ACT_DTE date, LOAN_AGE int, DLQ_STATUS int, MOD_FLAG string, ZB_CODE string, "
          "ZB_DTE date, LAST_UPB double, LPI_DTE date, FCC_DTE date, DISP_DTE date, "
          "DEFT_COST double, DEFT_PROCS double")


def month(i):
    return dt.date(2000 + i // 12, i % 12 + 1, 1)


def panel_rows(loan, statuses, mods=(), zbs=()):
    rows = []
    for i, s in enumerate(statuses):
        zb = "01" if i in zbs else None
        rows.append((loan, month(i), i, s, "Y" if i in mods else "N", zb, month(i) if zb else None,
                     1000.0 - i, None, None, None, 1.0, 2.0))
    return rows


def test_window_edges(spark):
    df = spark.createDataFrame(panel_rows("A", list(range(30))), SCHEMA)
    rows = enrich_panel(df).orderBy("LOAN_AGE").collect()
    first, last = rows[0], rows[-1]
    assert first.DLQ_LAG is None and first.DLQ_LAGs12 == []
    assert last.DLQ_NEXT12MAX is None and last.DLQ_NEXT24MAX is None
    assert rows[13].DLQ_LAGs12 == list(range(1, 13))  # 12 earlier rows, oldest first
    assert rows[5].DLQ_LAGs12 == [0, 1, 2, 3, 4]
    assert rows[0].DLQ_NEXT12MAX == 12 and rows[0].DLQ_NEXT24MAX == 24
    assert rows[20].DLQ_NEXT24MAX == 29


def test_frames_count_rows_not_months(spark):
    rows = panel_rows("A", [0, 1, 2])
    # a missing month: the third row is two years later, still "the next row"
    rows[2] = rows[2][:1] + (dt.date(2005, 1, 1),) + rows[2][2:]
    out = enrich_panel(spark.createDataFrame(rows, SCHEMA)).orderBy("LOAN_AGE").collect()
    assert out[1].DLQ_NEXT12MAX == 2


def test_sentinels_enter_maxima(spark):
    df = spark.createDataFrame(panel_rows("A", [0, -1, -2]), SCHEMA)
    rows = enrich_panel(df).orderBy("LOAN_AGE").collect()
    assert rows[0].DLQ_NEXT12MAX == -1  # all-unknown look-ahead gives -1, not null


def test_ties_broken_by_age(spark):
    rows = panel_rows("A", [1, 5, 2])
    rows = [r[:1] + (dt.date(2000, 1, 1),) + r[2:] for r in rows]  # same date for all
    out = enrich_panel(spark.createDataFrame(rows, SCHEMA)).orderBy("LOAN_AGE").collect()
    assert [r.DLQ_LAG for r in out] == [None, 1, 5]


def _hand_panel(spark):
    rows = (panel_rows("A", [0, 1, 3, 4, 0], mods=(1, 3), zbs=(2, 4))
            + panel_rows("B", [0, 0, 5], mods=(0,))
            + panel_rows("C", [0, 0, 0])
            + panel_rows("D", [0, 0], zbs=(1,)))
    return enrich_panel(spark.createDataFrame(rows, SCHEMA))


def test_first_events(spark):
    panel = _hand_panel(spark)
    mod = {r.LOAN_ID: r for r in first_modification(panel).collect()}
    assert set(mod) == {"A", "B"} and mod["A"].MOD_AGE == 1 and mod["B"].MOD_AGE == 0
    f3q = {r.LOAN_ID: r for r in first_serious_delinquency(panel).collect()}
    assert set(f3q) == {"A", "B"} and f3q["A"].F3Q_AGE == 2 and f3q["A"].F3Q_DLQ_LAGs12 == [0, 1]
    zb = zero_balance_events(panel).collect()
    assert sorted((r.LOAN_ID, r.ZB_AGE) for r in zb) == [("A", 2), ("A", 4), ("D", 1)]


def _rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def test_single_pass_events_equal_three_joins(spark):
    panel = _hand_panel(spark)
    mod, f3q, zb = first_modification(panel), first_serious_delinquency(panel), zero_balance_events(panel)
    by_joins = universe_outcome(event_universe(panel), mod, f3q, zb)
    single = loan_events(panel).select(*by_joins.columns)
    assert _rows(single) == _rows(by_joins)
    assert sorted(r[0] for r in event_universe(panel).collect()) == ["A", "B", "D"]


def test_outcome_fan_out_and_loan_count(spark):
    panel = _hand_panel(spark)
    loans = spark.createDataFrame([(x,) for x in "ABCDE"], "LOAN_ID string")
    mod, f3q, zb = first_modification(panel), first_serious_delinquency(panel), zero_balance_events(panel)
    out = loan_outcome(loans, mod, f3q, zb)
    # two zero-balance rows for A -> two outcome rows; J1 and J2 keep the loan count
    assert out.count() == 6
    assert loans.join(mod, "LOAN_ID", "left").join(f3q, "LOAN_ID", "left").count() == 5
    single = loans.join(loan_events(panel), "LOAN_ID", "left").select(*out.columns)
    assert _rows(single) == _rows(out)


def test_fixture_facts(spark):
    from conftest import SF001
    from mortar.plans.loan_level import build
    from mortar.sources.fixtures import fnma_acquisition, fnma_performance
    lvl = build(fnma_performance(spark, SF001), fnma_acquisition(spark, SF001))
    assert lvl.first_mod.count() == 145
    assert lvl.first_90d.count() == 150
    assert lvl.zero_balance.count() == 30
    assert lvl.outcome().count() == 15002
    assert lvl.outcome().select("LOAN_ID").distinct().count() == 15000
    assert lvl.perf_base.where(F.col("LOAN_AGE") < 0).count() == 300


def test_hot_loan_split_path_equals_plain(spark):
    """Loans over the threshold take the chunked path; results are identical."""
    from conftest import SF001
    from mortar.plans.loan_level import build
    from mortar.sources.fixtures import fnma_acquisition, fnma_performance
    from mortar.operators.panel import WINDOW_COLUMNS
    plain = build(fnma_performance(spark, SF001), fnma_acquisition(spark, SF001), hot_threshold=None)
    # every loan has 45-99 rows: a threshold of 60 makes about half of them hot,
    # and 25-row chunks force several chunk boundaries (with halos) per loan
    split = build(fnma_performance(spark, SF001), fnma_acquisition(spark, SF001), hot_threshold=60, chunk_rows=25)
    assert 0 < split.n_hot < 150
    cols = ["LOAN_ID", "ACT_DTE", "LOAN_AGE", *WINDOW_COLUMNS]
    assert _rows(split.panel.select(*cols)) == _rows(plain.panel.select(*cols))
    out_cols = plain.outcome().columns
    assert _rows(split.outcome().select(*out_cols)) == _rows(plain.outcome())
    for a, b in [(split.first_mod, plain.first_mod), (split.first_90d, plain.first_90d)]:
        assert _rows(a) == _rows(b.select(*a.columns))


def test_chunk_must_cover_frames(spark):
    import pytest
    from mortar.operators.panel import split_windows
    df = spark.createDataFrame(panel_rows("A", [0, 1]), SCHEMA)
    with pytest.raises(ValueError):
        split_windows(df, chunk_rows=10)


def test_min_by_equals_row_number(spark):
    from conftest import SF001
    from mortar.plans.loan_level import build
    from mortar.sources.fixtures import fnma_performance
    panel = build(fnma_performance(spark, SF001)).panel
    for fn in (first_modification, first_serious_delinquency):
        a = fn(panel)
        b = fn(panel, method="row_number").select(*a.columns)
        assert _rows(a) == _rows(b)


def test_fixture_numbering_split_path_equals_plain(spark):
    from conftest import SF001
    from mortar.sources.fixtures import numbered_events
    plain = numbered_events(spark, SF001, hot_threshold=None).select("event_id", "user_id", "k")
    split = numbered_events(spark, SF001, hot_threshold=70).select("event_id", "user_id", "k")
    assert dict(split.dtypes)["k"] == dict(plain.dtypes)["k"]
    assert _rows(split) == _rows(plain)


def _expected_windows(statuses, zbs, mods):
    out = []
    n = len(statuses)

    def mx(values):
        vals = [v for v in values if v is not None]
        return max(vals) if vals else None

    for i in range(n):
        out.append((
            statuses[i - 1] if i > 0 else None,
            statuses[max(0, i - 12):i],
            mx(statuses[i + 1:i + 13]), mx(statuses[i + 1:i + 25]),
            mx(zbs[i + 1:i + 13]), mx(zbs[i + 1:i + 25]),
            mx(mods[i + 1:i + 13]), mx(mods[i + 1:i + 25]),
        ))
    return out


def test_windows_match_python_reference_on_random_panels(spark):
    import numpy as np
    rng = np.random.default_rng(11)
    rows, expected = [], {}
    for loan in range(40):
        n = int(rng.integers(1, 60))
        statuses = [int(x) for x in rng.integers(-2, 7, n)]
        zbs = [None if rng.random() < 0.9 else f"0{int(rng.integers(1, 10))}" for _ in range(n)]
        mods = [str(rng.choice(["Y", "N"])) for _ in range(n)]
        lid = f"L{loan}"
        for i in range(n):
            rows.append((lid, month(i), i, statuses[i], mods[i], zbs[i], None, 1.0, None, None, None, 0.0, 0.0))
        for i, e in enumerate(_expected_windows(statuses, zbs, mods)):
            expected[(lid, i)] = e
    got = enrich_panel(spark.createDataFrame(rows, SCHEMA), hot_threshold=None).collect()
    assert len(got) == len(expected)
    for r in got:
        assert (r.DLQ_LAG, r.DLQ_LAGs12, r.DLQ_NEXT12MAX, r.DLQ_NEXT24MAX, r.ZBCODE_NEXT12, r.ZBCODE_NEXT24,
                r.MOD_NEXT12, r.MOD_NEXT24) == expected[(r.LOAN_ID, r.LOAN_AGE)]


def test_single_row_history(spark):
    df = spark.createDataFrame(panel_rows("S", [4], mods=(0,), zbs=(0,)), SCHEMA)
    r = enrich_panel(df, hot_threshold=None).collect()[0]
    assert r.DLQ_LAG is None and r.DLQ_LAGs12 == []
    assert r.DLQ_NEXT12MAX is None and r.ZBCODE_NEXT24 is None and r.MOD_NEXT12 is None
    ev = loan_events(enrich_panel(df, hot_threshold=None)).collect()
    assert len(ev) == 1 and ev[0].MOD_AGE == 0 and ev[0].F3Q_AGE == 0 and ev[0].ZB_AGE == 0


def test_fred_costs_and_missing_dates(spark):
    from conftest import SF001
    from mortar.plans.loan_level import build
    from mortar.schema import FRED
    from mortar.sources.fixtures import fred_performance
    lvl = build(fred_performance(spark, SF001), None, FRED)
    base = lvl.perf_base
    row = base.where(F.col("LEGAL_COST").isNotNull() & F.col("MAINT_COST").isNotNull()
                     & F.col("TAX_COST").isNotNull() & F.col("MISC_COST").isNotNull()).first()
    assert row.DEFT_COST == row.LEGAL_COST + row.MAINT_COST + row.TAX_COST + row.MISC_COST
    zb = zero_balance_events(lvl.panel).collect()
    assert zb and all(r.FCC_DTE is None and r.DISP_DTE is None for r in zb)


def test_one_loan_with_a_third_of_all_rows(spark):
    """The skew case: one loan holds a third of the panel; split path == plain."""
    from mortar.operators.events import loan_events
    from mortar.operators.panel import WINDOW_COLUMNS, hot_loans
    ids = spark.range(30000)
    panel = ids.select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("L"), (F.col("id") % 500).cast("string")))
        .alias("LOAN_ID"),
        F.date_add(F.lit(dt.date(2000, 1, 1)), F.col("id").cast("int")).alias("ACT_DTE"),
        F.col("id").cast("int").alias("LOAN_AGE"),
        ((F.col("id") * 7919) % 9 - 2).cast("int").alias("DLQ_STATUS"),
        F.when(F.col("id") % 97 == 0, F.lit("Y")).otherwise(F.lit("N")).alias("MOD_FLAG"),
        F.when(F.col("id") % 1013 == 0, F.lit("03")).alias("ZB_CODE"),
        F.lit(None).cast("date").alias("ZB_DTE"),
        F.col("id").cast("double").alias("LAST_UPB"),
        F.lit(None).cast("date").alias("LPI_DTE"), F.lit(None).cast("date").alias("FCC_DTE"),
        F.lit(None).cast("date").alias("DISP_DTE"),
        F.lit(1.0).alias("DEFT_COST"), F.lit(2.0).alias("DEFT_PROCS"),
    )
    cols = ["LOAN_ID", "ACT_DTE", "LOAN_AGE", *WINDOW_COLUMNS]
    plain = enrich_panel(panel, hot_threshold=None)
    split = enrich_panel(panel, hot_threshold=5000, chunk_rows=2000)
    assert _rows(split.select(*cols)) == _rows(plain.select(*cols))
    hot = hot_loans(panel, 5000)
    a = loan_events(split, hot=hot, n_hot=hot.count())
    b = loan_events(plain).select(*a.columns)
    assert _rows(a) == _rows(b)


def test_null_hot_key_is_split_too(spark):
    from mortar.operators.panel import WINDOW_COLUMNS
    rows = [(None, *r[1:]) for r in panel_rows("x", [i % 5 for i in range(200)])] + panel_rows("A", [0, 1, 2] * 30)
    panel = spark.createDataFrame(rows, SCHEMA)
    split = enrich_panel(panel, hot_threshold=80, chunk_rows=50)
    plain = enrich_panel(panel, hot_threshold=None)
    cols = ["LOAN_ID", "LOAN_AGE", *WINDOW_COLUMNS]
    assert _rows(split.select(*cols)) == _rows(plain.select(*cols))


def test_duplicated_months_have_one_order(spark):
    from mortar.operators.panel import WINDOW_COLUMNS
    twice = panel_rows("A", [i % 4 for i in range(90)]) + panel_rows("A", [i % 5 for i in range(90)], mods=range(0, 90, 7))
    twice += panel_rows("B", [1] * 40) * 2
    cols = ["LOAN_ID", "ACT_DTE", "LOAN_AGE", "DLQ_STATUS", "MOD_FLAG", *WINDOW_COLUMNS]
    wanted = None
    for parts in (1, 3, 8):
        panel = spark.createDataFrame(twice, SCHEMA).repartition(parts, "LAST_UPB")
        for how in ({"hot_threshold": None}, {"hot_threshold": 50, "chunk_rows": 25}):
            got = _rows(enrich_panel(panel, **how).select(*cols))
            wanted = wanted or got
            assert got == wanted
