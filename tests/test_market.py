"""As-of join, rate incentive, mark-to-market LTV and calendar frames on hand-made rows."""

import datetime as dt
import random

import pytest

from mortar.operators.asof import asof_join
from mortar.operators.calendar import CALENDAR_COLUMNS, enrich_calendar
from mortar.operators.market import filled_prices, mark_to_market, rate_incentive, term_bucket

from conftest import SF001


def d(y, m, day=1):
    return dt.date(y, m, day)


@pytest.mark.parametrize("hot", [None, 3])
def test_asof_join_takes_the_last_row_in_force(spark, hot):
    made = random.Random(3)
    days = [d(2000, 1) + dt.timedelta(made.randrange(400)) for _ in range(300)]
    left = [(i, made.choice(["a", "b", "c", None]), made.choice([*days, None])) for i in range(500)]
    right = [(k, made.choice(days), float(i)) for i, k in enumerate("aaaaaaaab" * 12)] + [(None, d(2000, 1), 1.0), ("a", None, 2.0)]
    got = asof_join(spark.createDataFrame(left, "id int, k string, t date").repartition(5),
                    spark.createDataFrame(right, "k string, q date, v double"), ["k"], "t", "q", ["v"], hot)
    assert got.columns == ["id", "k", "t", "q", "v"]
    want = {}
    for i, k, t in left:
        known = [(q, v) for kk, q, v in right if kk == k and k is not None and q is not None and t is not None and q <= t]
        want[i] = max(known) if known else (None, None)
    assert {r.id: (r.q, r.v) for r in got.collect()} == want


def test_asof_join_many_tasks_carry_over(spark):
    # one key, one quote at the start: every task but the first needs the carried value
    left = spark.range(5000).selectExpr("1 AS k", "date_add(date'2000-01-01', cast(id AS int)) AS t")
    right = spark.createDataFrame([(1, d(2000, 1, 3), 7.0)], "k int, q date, v double")
    out = asof_join(left, right, ["k"], "t", "q", ["v"], hot_threshold=10).groupBy("v").count().collect()
    assert {r.v: r["count"] for r in out} == {None: 2, 7.0: 4998}


def test_rate_incentive(spark):
    panel = spark.createDataFrame(
        [("a", d(2000, 1), 7.0), ("a", d(2000, 5), 7.0), ("b", d(2000, 5), 6.0), ("x", d(2000, 5), 6.0), (None, d(2000, 5), 6.0),
         ("a", None, 6.0), ("two", d(2000, 5), 1.0)], "LOAN_ID string, ACT_DTE date, LAST_RT double")
    loans = spark.createDataFrame([("a", 360), ("a", 360), ("b", 100), ("two", 120), ("two", 360)], "LOAN_ID string, ORIG_TRM int")
    quotes = spark.createDataFrame([(360, d(2000, 2, 9), 6.5), (360, d(2000, 6), 5.0), (120, d(2000, 5), 0.0)],
                                   "TERM_BUCKET int, QUOTE_DTE date, MKT_RT double")
    got = sorted([(r.LOAN_ID, str(r.ACT_DTE), r.TERM_BUCKET, r.MKT_RT, r.INCENTIVE, r.INCENTIVE_RATIO)
                  for r in rate_incentive(panel, loans, quotes).collect()], key=str)
    assert got == sorted([
        ("a", "2000-01-01", 360, None, None, None), ("a", "2000-05-01", 360, 6.5, 0.5, 7.0 / 6.5),
        ("b", "2000-05-01", 120, 0.0, 6.0, None), ("x", "2000-05-01", None, None, None, None),
        (None, "2000-05-01", None, None, None, None), ("a", "None", 360, None, None, None),
        ("two", "2000-05-01", None, None, None, None)], key=str)
    buckets = spark.createDataFrame([(n,) for n in (0, 6, 120, 121, 240, 241, 480, None)], "n int")
    assert [r.b for r in buckets.select(term_bucket("n").alias("b")).collect()] == [None, 120, 120, 180, 240, 360, 360, None]


def prices_of(spark, rows):
    return spark.createDataFrame(rows, "LEVEL string, REGION string, MONTH date, HPI double")


def test_gaps_are_interpolated_and_bad_months_are_gaps(spark):
    rows = [("ZIP3", "1", d(2000, 1), 100.0), ("ZIP3", "1", d(2000, 4), 130.0), ("ZIP3", "1", d(2000, 2), float("nan")),
            ("ZIP3", "1", d(2000, 3), 1.0), ("ZIP3", "1", d(2000, 3), 2.0), ("STATE", "1", d(2000, 1), -5.0),
            ("STATE", "1", d(2000, 2), 50.0), ("NATION", None, d(2000, 2), 50.0), ("ZIP3", "1", None, 7.0)]
    got = sorted((r.LEVEL, r._m - 24000, r.HPI, r.INTERPOLATED) for r in filled_prices(prices_of(spark, rows)).collect())
    assert got == [("STATE", 1, 50.0, False), ("ZIP3", 0, 100.0, False), ("ZIP3", 1, 110.0, True), ("ZIP3", 2, 120.0, True),
                   ("ZIP3", 3, 130.0, False)]


def test_mark_to_market_falls_back_by_level(spark):
    rows = [("ZIP3", "z", d(2000, 1), 100.0), ("ZIP3", "z", d(2000, 3), 120.0), ("STATE", "s", d(2000, 1), 100.0),
            ("STATE", "s", d(2001, 1), 200.0), ("NATION", "US", d(1999, 1), 50.0), ("NATION", "US", d(2002, 1), 100.0)]
    loans = spark.createDataFrame(
        [("a", 80.0, 80.0, d(2000, 1), "s", "z"), ("b", 80.0, 80.0, d(2000, 1), "s", None), ("c", 80.0, 0.0, d(1999, 1), None, "q"),
         ("d", 80.0, 80.0, d(1990, 1), "s", "z")],
        "LOAN_ID string, ORIG_AMT double, OLTV double, ORIG_DTE date, STATE string, ZIP_3 string")
    panel = spark.createDataFrame(
        [("a", d(2000, 3), 60.0), ("a", d(2001, 1), 60.0), ("a", d(2002, 1), 60.0), ("b", d(2000, 7), None), ("c", d(2002, 1), 60.0),
         ("d", d(2000, 1), 60.0), ("x", d(2000, 1), 60.0), ("a", None, 1.0)], "LOAN_ID string, ACT_DTE date, LAST_UPB double")
    got = {(r.LOAN_ID, str(r.ACT_DTE)): (r.HPI_LEVEL, r.HPI_GROWTH, r.MTM_LTV)
           for r in mark_to_market(panel, loans, prices_of(spark, rows)).collect()}
    assert got["a", "2000-03-01"] == ("ZIP3", 1.2, pytest.approx(50.0))
    assert got["a", "2001-01-01"] == ("STATE", 2.0, pytest.approx(30.0))
    assert got["a", "2002-01-01"][0] == "NATION" and got["b", "2000-07-01"][::2] == ("STATE", None)
    assert got["c", "2002-01-01"] == ("NATION", 2.0, None)
    assert got["d", "2000-01-01"] == got["x", "2000-01-01"] == got["a", "None"] == (None, None, None)


def test_every_level_and_null_occurs_on_the_given_tables(spark):
    from mortar.plans.queries import QUERIES
    import mortar.plans.analytics  # noqa: F401
    levels = {r.HPI_LEVEL for r in QUERIES["mark_to_market"](spark, SF001).select("HPI_LEVEL").distinct().collect()}
    assert {"ZIP3", "STATE", "NATION"} <= levels
    rows = QUERIES["rate_incentive"](spark, SF001)
    assert 0 < rows.where("MKT_RT is null").count() < rows.count()


def test_calendar_frames_and_the_hot_path(spark):
    perf = [("a", d(2000, 1), 1, None, "N"), ("a", d(2000, 3), 2, None, "N"), ("a", d(2000, 3), 5, "01", "Y"),
            ("a", d(2001, 3), 3, "09", None), ("a", d(2002, 3), 9, None, "Z"), ("a", None, 7, "05", "Y"), ("b", d(2000, 1), None, None, "N"),
            (None, d(2000, 1), 4, None, "N"), (None, d(2000, 2), 6, None, "N")]
    df = spark.createDataFrame(perf, "LOAN_ID string, ACT_DTE date, DLQ_STATUS int, ZB_CODE string, MOD_FLAG string")

    def rows(**how):
        return sorted([tuple(r) for r in enrich_calendar(df, **how).select("LOAN_ID", "ACT_DTE", "DLQ_STATUS", *CALENDAR_COLUMNS)
                       .collect()], key=str)
    plain = rows()
    by = {(r[0], str(r[1]), r[2]): r[3:] for r in plain}
    assert by["a", "2000-01-01", 1] == (None, [None] * 12, 5, 5, "01", "09", "Y", "Y")
    assert by["a", "2000-03-01", 2][1] == [None] * 10 + [1, None] and by["a", "2000-03-01", 2][2:4] == (3, 9)
    assert by["a", "2001-03-01", 3][1] == [5] + [None] * 11
    assert by["a", "None", 7] == (None,) * 8
    assert by[None, "2000-02-01", 6][0] == 4
    assert rows(hot_threshold=0) == rows(hot_threshold=2) == plain
