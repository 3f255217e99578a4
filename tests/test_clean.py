import datetime as dt

from pyspark.sql import functions as F

from mortar.functions.cleaning import channel_bucket, dlq_status, parse_date, total
from mortar.operators.clean import clean_acquisition, clean_performance, performance_base
from mortar.schema import FNMA
from mortar.sources.text import read_acquisition, read_tape, rejected_rows


def test_parse_date_patterns_and_bad_text(spark):
    df = spark.createDataFrame(
        [("02/2001", "02/15/2001", "200102"), ("1/2000", "xx", None), ("", "13/01/2000", "2001")],
        "a string, b string, c string",
    )
    out = df.select(
        parse_date("a", "MM/yyyy").alias("a"),
        parse_date("b", "MM/dd/yyyy").alias("b"),
        parse_date("c", "yyyyMM").alias("c"),
    ).collect()
    assert out[0] == (dt.date(2001, 2, 1), dt.date(2001, 2, 15), dt.date(2001, 2, 1))
    assert out[1] == (None, None, None)  # bad text gives null, never a failed job
    assert out[2] == (None, None, None)


def test_dlq_status_codes(spark):
    df = spark.createDataFrame([(None,), ("X",), ("3",), ("X1",), ("0",)], "s string")
    got = [r[0] for r in df.select(dlq_status("s")).collect()]
    assert got == [-1, -2, 3, None, 0]


def test_defaults_keep_column_types_and_ltv_fallback(spark):
    raw = spark.createDataFrame(
        [("1", None, None, None, None, None), ("2", 80.0, 0.0, 2, 700.0, "1"), ("3", None, 0.0, None, None, None)],
        "LOAN_ID string, OLTV double, OCLTV double, NUM_BO int, CSCORE_B double, MI_TYPE string",
    )
    out = clean_acquisition(raw, FNMA)
    types = dict(out.dtypes)
    assert types["NUM_BO"] == "int" and types["OLTV"] == "double" and types["MI_TYPE"] == "string"
    rows = {r.LOAN_ID: r for r in out.collect()}
    assert rows["1"].OLTV == 0.0 and rows["1"].OCLTV == 0.0 and rows["1"].NUM_BO == -1
    assert rows["1"].CSCORE_B == -1.0 and rows["1"].MI_TYPE == "0"
    assert rows["2"].OCLTV == 80.0  # 0 falls back to OLTV
    assert rows["3"].OCLTV == 0.0   # fallback after defaults: OLTV defaulted to 0


def test_totals_null_propagation(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in df.select(total(["a", "b"])).collect()] == [3.0, None]
    assert [r[0] for r in df.select(total(["a", "b"], nulls_as_zero=True)).collect()] == [3.0, 1.0]


def test_channel_bucket(spark):
    df = spark.createDataFrame([("R",), ("C",), ("B",), ("T",), (None,)], "c string")
    assert [r[0] for r in df.select(channel_bucket("c")).collect()] == ["R1", "R1", "B1", "T", None]


def test_simple_path_filters_negative_age_and_keeps_list(spark):
    from mortar.sources.fixtures import fnma_performance
    from conftest import SF001
    out = clean_performance(fnma_performance(spark, SF001), FNMA)
    assert out.columns == FNMA.performance.keep_names
    assert out.where("LOAN_AGE < 0").count() == 0
    assert out.count() == 9700


def test_enriched_base_totals(spark):
    from mortar.sources.fixtures import fnma_performance
    from conftest import SF001
    base = performance_base(fnma_performance(spark, SF001), FNMA)
    assert base.where(F.col("DEFT_COST").isNull()).count() > 0
    assert base.count() == 10000  # negative ages stay for the windows


def test_malformed_text_rows(spark, tmp_dir):
    good = "|".join(["7", "R", "S", "4.5", "100000.0", "360", "01/2000", "03/2000"] + [""] * 17)
    bad_date = "|".join(["8", "R", "S", "4.5", "100000.0", "360", "1/2000", "xx"] + [""] * 17)
    bad_num = "|".join(["9", "R", "S", "abc", "100000.0", "360", "01/2000", "03/2000"] + [""] * 17)
    short = "10|R|S"
    path = tmp_dir + "/tape"
    spark.createDataFrame([(x,) for x in [good, bad_date, bad_num, short]], "v string").coalesce(1) \
        .write.text(path)
    loans = {r.LOAN_ID: r for r in read_acquisition(spark, path, FNMA).collect()}
    assert loans["7"].ORIG_DTE == dt.date(2000, 1, 1) and loans["7"].FRST_DTE == dt.date(2000, 3, 1)
    assert loans["8"].ORIG_DTE is None and loans["8"].FRST_DTE is None
    assert loans["9"].ORIG_RT is None
    assert loans["10"].ORIG_TRM is None and loans["10"].NUM_BO == -1
    assert len(rejected_rows(spark, path, FNMA.acquisition).collect()) == 2  # bad number, short row
    assert read_tape(spark, path, FNMA.acquisition).count() == 4


def test_staged_scan(spark, tmp_dir):
    from conftest import SF0001
    from mortar.operators.clean import clean_acquisition, staged_performance
    from mortar.sources.fixtures import fnma_acquisition, fnma_performance
    from mortar.sources.text import read_tape, write_tape
    assert "SellerName" not in clean_acquisition(fnma_acquisition(spark, SF0001), FNMA).columns
    perf = fnma_performance(spark, SF0001)
    write_tape(perf, tmp_dir + "/perf", FNMA.performance)
    staged = staged_performance(read_tape(spark, tmp_dir + "/perf", FNMA.performance), FNMA)
    assert staged.columns == FNMA.performance.names  # all columns kept
    assert staged.where(F.col("Adj_Month_To_Mat").isNull()).count() == 0  # defaults filled
    assert staged.where(F.col("Adj_Month_To_Mat") == -1).count() == perf.where(F.col("Adj_Month_To_Mat").isNull()).count()
    assert dict(staged.dtypes)["ACT_DTE"] == "date" and dict(staged.dtypes)["DLQ_STATUS"] == "string"


def test_cent_rounding_same_in_spark_and_numpy(spark):
    import numpy as np
    from mortar.functions.cleaning import round_half_up
    from mortar.operators.schedule import _round_cents
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.uniform(-1e6, 1e6, 2000), np.round(rng.uniform(0, 1e4, 500), 3) + 0.005,
                           [0.125, 2.675, -0.005, 1e-9, 0.0]])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = [r[0] for r in df.select(round_half_up("x", 2)).collect()]
    assert np.array_equal(np.array(got), _round_cents(vals) + 0.0)


def test_date_patterns_round_trip(spark):
    import random
    from pyspark.sql import functions as F
    rnd = random.Random(5)
    days = [dt.date(rnd.randint(1990, 2030), rnd.randint(1, 12), rnd.randint(1, 28)) for _ in range(300)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    for pattern, first_of_month in [("MM/yyyy", True), ("MM/dd/yyyy", False), ("yyyyMM", True)]:
        back = df.select("d", parse_date(F.date_format("d", pattern), pattern).alias("p")).collect()
        for r in back:
            assert r.p == (r.d.replace(day=1) if first_of_month else r.d), pattern
