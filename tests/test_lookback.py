"""Stateful look-back on the stream against the batch windows, with restarts and late rows."""

import datetime as dt

from pyspark.sql import functions as F

from mortar.operators.clean import performance_base
from mortar.operators.panel import enrich_panel
from mortar.schema import FNMA
from mortar.sources.fixtures import fnma_performance
from mortar.sources.text import write_tape
from mortar.streaming import lookback
from mortar.streaming.lookback import _step, ingest_lookback, late_rows

from conftest import SF0001


def test_step_keeps_twelve_statuses_and_first_events():
    def row(m, status, mod="N"):
        return {"LOAN_ID": "a", "ACT_DTE": dt.date(2000 + m // 12, m % 12 + 1, 1), "DLQ_STATUS": status, "MOD_FLAG": mod}
    out, state = _step([row(i, i % 5, "Y" if i in (2, 9) else None) for i in range(20)], (None, [], False, False), 12, 3)
    assert out[0]["DLQ_LAG"] is None and out[0]["DLQ_LAGs12"] == []
    assert out[15]["DLQ_LAG"] == 14 % 5 and out[15]["DLQ_LAGs12"] == [i % 5 for i in range(3, 15)]
    assert [i for i, r in enumerate(out) if r["FIRST_MOD"]] == [2] and [i for i, r in enumerate(out) if r["FIRST_90D"]] == [3]
    assert len(state[1]) == 12 and state[2:] == (True, True)
    again, after = _step([row(5, 9), row(20, None), row(21, 1)], state, 12, 3)
    assert [r["LATE"] for r in again] == [True, False, False] and again[0]["DLQ_LAG"] is None
    assert again[2]["DLQ_LAG"] is None and len(again[2]["DLQ_LAGs12"]) == 11  # an unknown status is in no list
    assert after[0] == dt.date(2001, 10, 1)


def test_three_landings_with_restarts_and_late_rows(spark, tmp_dir):
    perf = fnma_performance(spark, SF0001)
    landing, target, ckpt = (f"{tmp_dir}/{n}" for n in ("landing", "out", "ckpt"))
    for part, rule in enumerate(("LOAN_AGE < 15", "LOAN_AGE between 15 and 39", "LOAN_AGE > 39 or LOAN_AGE = 3")):
        write_tape(perf.where(rule), f"{landing}/part{part}", FNMA.performance)
        ingest_lookback(spark, landing + "/*", target, ckpt, FNMA)
    landed = spark.read.parquet(target)
    late = late_rows(landed)
    assert late.count() == perf.where("LOAN_AGE = 3").count()
    assert late.where("DLQ_LAG is not null or FIRST_MOD is not null").count() == 0

    def rows(df):
        return sorted(map(str, df.select("LOAN_ID", "ACT_DTE", "LOAN_AGE", "DLQ_LAG", "DLQ_LAGs12").collect()))
    batch = enrich_panel(performance_base(perf, FNMA))
    assert rows(landed.where(~F.col("LATE"))) == rows(batch)


def test_loans_of_a_bucket_keep_their_own_states(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(lookback, "BUCKETS", 3)
    perf = spark.range(40).selectExpr("concat('L', id % 10) as LOAN_ID", "int(id / 10) as m").selectExpr(
        "LOAN_ID", "add_months(date'2000-01-01', m) as ACT_DTE", "m as LOAN_AGE",
        "string((m + int(substr(LOAN_ID, 2))) % 6) as DLQ_STATUS", "if(LOAN_ID = 'L7' and m > 0, 'Y', 'N') as MOD_FLAG")
    perf = perf.select(*[F.col(c.name) if c.name in perf.columns else F.lit(None).cast(c.spark_type).alias(c.name)
                         for c in FNMA.performance.columns])
    landing, target, ckpt = (f"{tmp_dir}/{n}" for n in ("landing", "out", "ckpt"))
    # the second landing lacks a loan and brings another
    for part, rule in enumerate(("LOAN_AGE < 2 and LOAN_ID <> 'L3'", "LOAN_AGE = 2 and LOAN_ID <> 'L5'", "LOAN_AGE = 3")):
        write_tape(perf.where(rule), f"{landing}/part{part}", FNMA.performance)
        ingest_lookback(spark, landing + "/*", target, ckpt, FNMA)
    landed = {(r.LOAN_ID, r.LOAN_AGE): r for r in spark.read.parquet(target).collect()}
    assert len(landed) == 37 and not any(r.LATE for r in landed.values())
    for (loan, m), r in landed.items():
        seen = [k for k in range(m) if (loan, k) in landed]
        want = [(k + int(loan[1])) % 6 for k in seen]
        assert r.DLQ_LAGs12 == want and r.DLQ_LAG == (want[-1] if want else None)
        assert r.FIRST_MOD == (loan == "L7" and m == 1)
    assert spark.read.format("statestore").load(ckpt).count() <= 3
