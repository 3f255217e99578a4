"""Sketches merged over vintages against exact figures."""

from pyspark.sql import functions as F

from mortar.operators.profile import QUANTILES, merge_profiles, profile_report, tape_profile
from mortar.sources.fixtures import fnma_acquisition

from conftest import SF001


def test_merged_profile_is_within_its_error(spark, tmp_dir):
    tape = fnma_acquisition(spark, SF001)
    tape_profile(tape).write.parquet(tmp_dir)
    stored = spark.read.parquet(tmp_dir)
    assert stored.count() == 27 * (len(tape.columns) - 1)
    merged = {r.COLUMN: r for r in profile_report(merge_profiles(stored)).collect()}
    n = tape.count()
    columns = [c for c in tape.columns if c != "ACQ"]
    exact = tape.agg(*[F.count_distinct(c).alias(c) for c in columns]).first()
    known = tape.agg(*[F.count(c).alias(c) for c in columns]).first()
    for c in columns:
        assert merged[c].N_ROWS == n and merged[c].N_NULLS == n - known[c], c
        assert abs(merged[c].N_DISTINCT - exact[c]) <= max(1, 0.03 * exact[c]), c
    values = sorted(r[0] for r in tape.select("ORIG_AMT").collect())
    for q, v in zip(QUANTILES, merged["ORIG_AMT"].AT_QUANTILES):
        rank = sum(x <= v for x in values) / n
        assert abs(rank - q) < 0.03
    assert merged["ORIG_DTE"].AT_QUANTILES is not None and merged["PURPOSE"].AT_QUANTILES is None
    top = {r["item"]: r["count"] for r in merged["ORIG_CHN"].TOP_VALUES}
    assert top == {r.ORIG_CHN: r["count"] for r in tape.groupBy("ORIG_CHN").count().collect()}


def test_vintages_kept_apart_nulls_and_empty(spark):
    df = spark.createDataFrame([("q1", None, None, 1), ("q1", None, None, 2), ("q2", "x", 1.5, None)],
                               "ACQ string, A string, B double, C int")
    got = {(r.ACQ, r.COLUMN): (r.N_ROWS, r.N_NULLS, r.N_DISTINCT) for r in profile_report(tape_profile(df)).collect()}
    assert got == {("q1", "A"): (2, 2, 0), ("q1", "B"): (2, 2, 0), ("q1", "C"): (2, 0, 2),
                   ("q2", "A"): (1, 0, 1), ("q2", "B"): (1, 0, 1), ("q2", "C"): (1, 1, 0)}
    both = {(r.COLUMN): (r.N_ROWS, r.N_NULLS, r.N_DISTINCT, r.AT_QUANTILES and r.AT_QUANTILES[2])
            for r in profile_report(merge_profiles(tape_profile(df))).collect()}
    assert both == {"A": (3, 2, 1, None), "B": (3, 2, 1, 1.5), "C": (3, 1, 2, 1.0)}
    assert tape_profile(df.where("false")).count() == 0
