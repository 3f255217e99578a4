import numpy as np
import pytest
from pyspark.sql import functions as F

from mortar.operators.schedule import (
    payment_table, rejected_loans, scheduled_balance_at_age, schedule_long, schedule_ppmt, schedule_unmasked,
    schedule_wide, with_level_payment,
)


def loans_df(spark, rows):
    return spark.createDataFrame(rows, "LOAN_ID string, ORIG_AMT double, ORIG_RT double, ORIG_TRM int")


def recurrence(p, rate, n, months, start=0, mask=True):
    r = rate / 1200.0
    a = p * (r / (1 - (1 + r) ** (-n))) if r else p / n
    b = p
    for _ in range(start):
        b = b - (a - b * r)
    out = [b]
    for t in range(start + 1, start + months):
        b = b - (a - b * r)
        v = b
        if mask:
            v = b if t < n else (0.0 if t == n else -999.0)
        out.append(v)
    return out


def test_closed_form_equals_recurrence(spark):
    rows = [("1", 200000.0, 3.625, 360), ("2", 55000.0, 7.875, 180), ("3", 1000.0, 5.0, 6)]
    loans = loans_df(spark, rows)
    got = {}
    for r in schedule_long(loans, None).collect():
        got.setdefault(r.LOAN_ID, []).append((r.LOAN_AGE, r.SCHD_UPB))
    for lid, p, rate, n in rows:
        exp = recurrence(p, rate, n, 360)
        vals = [v for _, v in sorted(got[lid])]
        assert len(vals) == 360  # N is the longest term in the set
        assert np.allclose(vals, exp, atol=1e-6)


def test_term_mask_and_month_count(spark):
    loans = loans_df(spark, [("s", 1000.0, 6.0, 6), ("l", 1000.0, 6.0, 360)])
    rows = {(r.LOAN_ID, r.LOAN_AGE): r.SCHD_UPB for r in schedule_long(loans, 12).collect()}
    assert len(rows) == 24  # N = min(360, 12)
    assert rows[("s", 6)] == 0.0
    assert all(rows[("s", t)] == -999.0 for t in range(7, 12))
    assert rows[("s", 0)] == 1000.0 and rows[("l", 11)] > 0


def test_month_count_is_property_of_the_set(spark):
    loans = loans_df(spark, [("a", 1000.0, 6.0, 6), ("b", 1000.0, 6.0, 10)])
    assert schedule_long(loans, 12).count() == 20  # N = longest term = 10


def test_start_offset_first_column_unmasked(spark):
    loans = loans_df(spark, [("s", 1000.0, 6.0, 6), ("l", 1000.0, 6.0, 360)])
    rows = {(r.LOAN_ID, r.LOAN_AGE): r.SCHD_UPB for r in schedule_long(loans, 12, start_period=3).collect()}
    assert min(a for _, a in rows) == 3 and max(a for _, a in rows) == 14
    exp = recurrence(1000.0, 6.0, 6, 12, start=3)
    assert rows[("s", 3)] == pytest.approx(exp[0]) and rows[("s", 6)] == 0.0 and rows[("s", 7)] == -999.0


def test_zero_rate_straight_line(spark):
    loans = loans_df(spark, [("z", 1200.0, 0.0, 12)])
    vals = sorted((r.LOAN_AGE, r.SCHD_UPB) for r in schedule_long(loans, 12).collect())
    assert [v for _, v in vals] == [1200.0 - 100.0 * t for t in range(12)]
    assert with_level_payment(loans).first().PMT == 100.0


def test_wide_equals_long(spark):
    loans = loans_df(spark, [("a", 5000.0, 4.0, 10), ("b", 9000.0, 7.0, 360)])
    wide = {r.LOAN_ID: r.SCHD_UPB for r in schedule_wide(loans, 12).collect()}
    long_ = {}
    for r in schedule_long(loans, 12).collect():
        long_.setdefault(r.LOAN_ID, {})[r.LOAN_AGE] = r.SCHD_UPB
    for k in wide:
        assert wide[k] == [long_[k][t] for t in range(len(wide[k]))]


def test_ppmt_and_unmasked_agree_and_run_past_term(spark):
    loans = loans_df(spark, [("a", 5000.0, 4.0, 6)])
    a = sorted((r.LOAN_AGE, r.SCHD_UPB) for r in schedule_ppmt(loans, 12).collect())
    b = sorted((r.LOAN_AGE, r.SCHD_UPB) for r in schedule_unmasked(loans, 12).collect())
    assert np.allclose([v for _, v in a], [v for _, v in b], atol=1e-7)
    exp = recurrence(5000.0, 4.0, 6, 12, mask=False)
    assert np.allclose([v for _, v in b], exp, atol=1e-7)
    assert b[6][1] == pytest.approx(0.0, abs=1e-6) and b[8][1] < 0


def test_sample_payment_table(spark):
    loans = loans_df(spark, [("s", 55000.0, 7.875, 180)])
    rows = sorted(payment_table(loans, round_payment=True).collect(), key=lambda r: r.PMT_NO)
    assert len(rows) == 180
    assert round(rows[0].PAYMENT, 2) == 521.65
    assert rows[0].INTEREST == 360.94 and round(rows[0].PRINCIPAL, 2) == 160.71
    assert round(rows[0].END_BAL, 2) == 54839.29
    assert round(rows[3].END_BAL, 2) == 54350.79
    for prev, cur in zip(rows, rows[1:]):
        assert cur.BEG_BAL == prev.END_BAL  # the rounded interest feeds the next balance


def test_payment_table_every_loan(spark):
    loans = loans_df(spark, [(str(i), 1000.0 + i, 3.0 + i % 5, 6 + i % 30) for i in range(200)])
    n = payment_table(loans).groupBy("LOAN_ID").count()
    got = {r.LOAN_ID: r["count"] for r in n.collect()}
    assert got == {str(i): 6 + i % 30 for i in range(200)}


def test_schedule_in_place_equals_exploded_join(spark):
    loans = loans_df(spark, [("a", 5000.0, 4.0, 6), ("b", 9000.0, 7.0, 360)])
    panel = spark.createDataFrame([(lid, age) for lid in "abc" for age in range(-2, 15)],
                                  "LOAN_ID string, LOAN_AGE int")
    in_place = scheduled_balance_at_age(panel, loans, 12)
    joined = panel.join(schedule_long(loans, 12), ["LOAN_ID", "LOAN_AGE"], "left")
    a = sorted((r.LOAN_ID, r.LOAN_AGE, r.SCHD_UPB) for r in in_place.collect())
    b = sorted((r.LOAN_ID, r.LOAN_AGE, r.SCHD_UPB) for r in joined.collect())
    assert a == b


def test_closed_form_random_loans(spark):
    rng = np.random.default_rng(7)
    rows = [(str(i), float(rng.integers(1_000, 900_000)), float(rng.choice([0.0, 1.5, 3.625, 7.875, 12.0])),
             int(rng.choice([6, 10, 60, 120, 180, 360]))) for i in range(300)]
    loans = loans_df(spark, rows)
    got = {}
    for r in schedule_long(loans, 36).collect():
        got.setdefault(r.LOAN_ID, {})[r.LOAN_AGE] = r.SCHD_UPB
    for lid, p, rate, n in rows:
        exp = recurrence(p, rate, n, 36)
        vals = [got[lid][t] for t in range(36)]
        assert np.allclose(vals, exp, rtol=1e-9, atol=1e-6), lid


def test_fill_skips_beyond_term_marker(spark):
    from mortar.operators.schedule import panel_with_schedule
    # a 360-month loan in the set makes N = 12, so ages 6..9 are scheduled
    loans = loans_df(spark, [("s", 1000.0, 6.0, 6), ("l", 1000.0, 6.0, 360)])
    panel = spark.createDataFrame([("s", age, None) for age in range(0, 10)],
                                  "LOAN_ID string, LOAN_AGE int, LAST_UPB double")
    got = {r.LOAN_AGE: r.LAST_UPB for r in panel_with_schedule(panel, loans, 12).collect()}
    assert got[0] == 1000.0 and got[5] > 0
    assert got[6] == 0.0                       # paid off at the term
    assert all(got[a] is None for a in (7, 8, 9))  # past the term: no -999 balance


def test_scalar_inputs(spark):
    from mortar.functions.amortize import level_payment, masked_balance
    row = spark.range(1).select(
        level_payment(55000.0, 7.875 / 1200.0, 180).alias("a"),
        masked_balance(1000.0, 0.0, 10, 4).alias("b"),
        masked_balance(1000.0, 0.005, 6, 7).alias("c"),
    ).first()
    assert round(row.a, 2) == 521.65 and row.b == 600.0 and row.c == -999.0


BAD = [("ok", 1000.0, 6.0, 6), ("zero", 1000.0, 6.0, 0), ("neg", 1000.0, 6.0, -3), ("noterm", 1000.0, 6.0, None),
       ("norate", 1000.0, None, 6), ("noamt", None, 6.0, 6), (None, 1000.0, 6.0, 6), ("long", 1000.0, 6.0, 100_000_000),
       ("flat", 1200.0, 0.0, 12), ("flat0", 1200.0, 0.0, 0)]


def test_unusable_loans_neither_fail_nor_vanish(spark):
    from mortar.operators.schedule import panel_with_schedule, rejected_loans
    loans = loans_df(spark, BAD)
    pay = {r.LOAN_ID: r.PMT for r in with_level_payment(loans).collect()}
    assert pay["ok"] > 0 and pay["flat"] == 100.0
    assert all(pay[k] is None for k in ("zero", "neg", "noterm", "norate", "noamt", "flat0"))
    assert schedule_long(loans, 12).where("LOAN_ID = 'zero' and SCHD_UPB is not null").count() == 0
    for f in (schedule_long, schedule_ppmt, schedule_unmasked, schedule_wide):
        assert f(loans, 12).count() > 0
        assert f(loans_df(spark, BAD[1:4]), None).where("LOAN_ID = 'ok'").count() == 0  # no usable term at all
    rejected = {r.LOAN_ID: r.REASON for r in rejected_loans(loans).collect()}
    assert rejected == {"zero": "term below one month", "neg": "term below one month", "noterm": "no term",
                        "norate": "no rate", "noamt": "no amount", None: "no loan id", "long": "term too long",
                        "flat0": "term below one month"}
    paid = {r.LOAN_ID: r["count"] for r in payment_table(loans).groupBy("LOAN_ID").count().collect()}
    assert paid == {"ok": 6, "flat": 12}
    panel = spark.createDataFrame([(k, 1, None) for k, *_ in BAD], "LOAN_ID string, LOAN_AGE int, LAST_UPB double")
    filled = {r.LOAN_ID: r.LAST_UPB for r in panel_with_schedule(panel, loans, 12).collect()}
    assert filled["ok"] > 0 and filled["zero"] is None and filled[None] is None


def test_a_repeated_loan_does_not_double_the_panel(spark):
    loans = loans_df(spark, [("a", 5000.0, 4.0, 6), ("a", 5000.0, 4.0, 6), ("b", 9000.0, 7.0, 360)])
    panel = spark.createDataFrame([("a", 1), ("b", 2)], "LOAN_ID string, LOAN_AGE int")
    assert scheduled_balance_at_age(panel, loans, 12).count() == 2


def test_a_loan_with_several_sets_of_terms_is_rejected_alone(spark):
    loans = loans_df(spark, [("a", 5000.0, 4.0, 6), ("a", 6000.0, 4.0, 6), ("b", 9000.0, 7.0, 360), ("b", 9000.0, 7.0, 360),
                             ("c", 1.0, None, 5), ("c", 1.0, 2.0, 5)])
    panel = spark.createDataFrame([("a", 1), ("b", 2), ("c", 1)], "LOAN_ID string, LOAN_AGE int")
    got = {r.LOAN_ID: r.SCHD_UPB for r in scheduled_balance_at_age(panel, loans, 12).collect()}
    assert got["a"] is None and got["b"] > 0 and got["c"] is None
    assert sorted((r.LOAN_ID, r.REASON) for r in rejected_loans(loans).collect()) == [
        ("a", "several sets of terms"), ("a", "several sets of terms"), ("c", "no rate"), ("c", "several sets of terms")]


def test_corrupt_terms_do_not_stretch_the_horizon(spark):
    loans = loans_df(spark, [("a", 5000.0, 4.0, 6), ("b", 5000.0, 4.0, 100_000_000), ("c", 5000.0, 4.0, 3000),
                             ("d", None, 4.0, 900)])
    assert {r.LOAN_ID: r["count"] for r in schedule_long(loans, None).groupBy("LOAN_ID").count().collect()} == {
        k: 6 for k in "abcd"}
    assert schedule_unmasked(loans, None).count() == schedule_ppmt(loans, None).count() == 24
    assert {len(r.SCHD_UPB) for r in schedule_wide(loans, None).collect()} == {6}
    panel = spark.createDataFrame([("a", 5), ("a", 7)], "LOAN_ID string, LOAN_AGE int")
    assert [r.SCHD_UPB is None for r in scheduled_balance_at_age(panel, loans, None).orderBy("LOAN_AGE").collect()] == [
        False, True]


def test_rounded_and_unrounded_payment(spark):
    loans = loans_df(spark, [("s", 55000.0, 7.875, 180)])
    last = {how: payment_table(loans, round_payment=how).where("PMT_NO = 180").first().END_BAL for how in (True, False)}
    assert round(last[True], 2) == -0.81 and round(last[False], 2) == -0.05


def test_payment_blocks_are_cut_by_rows(spark, monkeypatch):
    import mortar.operators.schedule as schedule
    loans = [(str(i), 1000.0 + i, 3.0, 6 + 37 * (i % 30)) for i in range(120)]
    whole = sorted(map(tuple, payment_table(loans_df(spark, loans)).collect()))
    monkeypatch.setattr(schedule, "_BLOCK_ROWS", 100)
    assert sorted(map(tuple, payment_table(loans_df(spark, loans)).collect())) == whole
