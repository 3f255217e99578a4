from pyspark.sql import types as T

from mortar.schema import FNMA, FRED, agency, spark_type


def test_column_counts_and_keep_lists():
    assert len(FNMA.acquisition.columns) == 25
    assert len(FNMA.performance.columns) == 31
    assert len(FRED.acquisition.columns) == 26
    assert len(FRED.performance.columns) == 26
    assert FNMA.acquisition.dropped_names == ["SellerName"]
    assert len(FNMA.performance.dropped_names) == 17
    assert sorted(FRED.acquisition.dropped_names) == sorted(["MSA", "SellerName", "SERVICER", "flag_sc"])
    assert len(FRED.performance.dropped_names) == 15


def test_agency_selection():
    assert agency("FNMA") is FNMA
    assert agency("FRED") is FRED
    assert agency("anything") is FRED


def test_types_and_read_schema():
    assert spark_type("float") == T.DoubleType()
    assert spark_type("int") == T.IntegerType()
    assert spark_type("date") == T.DateType()
    assert spark_type("whatever") == T.StringType()
    st = FNMA.performance.read_struct()
    assert st["ACT_DTE"].dataType == T.StringType()  # dates are parsed after the scan
    assert st["LOAN_AGE"].dataType == T.IntegerType()
    assert FNMA.acquisition["ORIG_DTE"].pattern == "MM/yyyy"
    assert FNMA.performance["ACT_DTE"].pattern == "MM/dd/yyyy"
    assert FRED.performance["ACT_DTE"].pattern == "yyyyMM"


def test_hand_written_text_lines(spark, tmp_dir):
    """Dates, defaults and totals of literal tape lines, apart from any writer."""
    import datetime as dt
    from mortar.operators.clean import clean_acquisition, performance_base
    from mortar.sources.text import read_tape
    acq = "10|R|Seller|7.5|55000|180|03/2000|05/2000|80||||||P|SF||P|CA|941||FRM|||N"
    perf = ("10|12/01/2000|S|7.5|54000|9|||01/2030|100|3|Y|03|11/2000|10/15/2000|10/20/2000|10/25/2000|"
            "1|2|4|8|16|32|64|128|256|0|0|N|0|N")
    for name, line in (("acq", acq), ("perf", perf)):
        spark.createDataFrame([(line,)], "v string").write.text(f"{tmp_dir}/{name}")
    loan = clean_acquisition(read_tape(spark, tmp_dir + "/acq", FNMA.acquisition), FNMA).first()
    assert (loan.ORIG_DTE, loan.FRST_DTE) == (dt.date(2000, 3, 1), dt.date(2000, 5, 1))
    assert (loan.OLTV, loan.OCLTV, loan.NUM_BO, loan.DTI, loan.CSCORE_B) == (80.0, 80.0, -1, -1, -1.0)
    assert (loan.NUM_UNIT, loan.MI_PCT, loan.CSCORE_C, loan.MI_TYPE, loan.STATE) == (-1, 0, -1, "0", "CA")
    m = performance_base(read_tape(spark, tmp_dir + "/perf", FNMA.performance), FNMA).first()
    assert (m.ACT_DTE, m.Maturity_Date, m.ZB_DTE) == (dt.date(2000, 12, 1), dt.date(2030, 1, 1), dt.date(2000, 11, 1))
    assert (m.LPI_DTE, m.FCC_DTE, m.DISP_DTE) == (dt.date(2000, 10, 15), dt.date(2000, 10, 20), dt.date(2000, 10, 25))
    assert (m.DEFT_COST, m.DEFT_PROCS) == (1 + 2 + 4 + 8 + 16, 32 + 64 + 128 + 256)
    fred = "F1|200011|1000|2|4|300||N|||5.5|0||1|2|4|9|8|16|32|64||0|N|N|70"
    spark.createDataFrame([(fred,)], "v string").write.text(f"{tmp_dir}/fred")
    f = performance_base(read_tape(spark, tmp_dir + "/fred", FRED.performance), FRED).first()
    assert f.ACT_DTE == dt.date(2000, 11, 1) and (f.DEFT_COST, f.DEFT_PROCS) == (8 + 16 + 32 + 64, 1 + 2 + 4)
