import os

from pyspark.sql import functions as F

from mortar.schema import FNMA
from mortar.sinks.parquet import save_parquet, save_table, save_vintage, sorted_for_sink, stage_to_vintage
from mortar.sources.fixtures import fnma_acquisition, fnma_performance
from mortar.operators.clean import clean_acquisition, performance_base
from mortar.sources.text import read_acquisition, read_tape, write_tape

from conftest import SF0001


def _local(path):
    return path.removeprefix("file:")


def _rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def test_text_round_trip(spark, tmp_dir):
    acq = fnma_acquisition(spark, SF0001)
    perf = fnma_performance(spark, SF0001)
    write_tape(acq, tmp_dir + "/acq", FNMA.acquisition)
    write_tape(perf, tmp_dir + "/perf", FNMA.performance)
    a = read_acquisition(spark, tmp_dir + "/acq", FNMA)
    b = clean_acquisition(acq, FNMA).drop("ACQ")
    assert _rows(a) == _rows(b.select(*a.columns))
    p = performance_base(read_tape(spark, tmp_dir + "/perf", FNMA.performance), FNMA)
    q = performance_base(perf, FNMA)
    assert _rows(p) == _rows(q.select(*p.columns))


def test_vintage_overwrite_keeps_other_vintages(spark, tmp_dir):
    loans = clean_acquisition(fnma_acquisition(spark, SF0001), FNMA)
    path = save_vintage(loans, tmp_dir, "FNMA", "Loan")
    n_all = loans.count()
    one = loans.where(F.col("ACQ") == "2000Q1")
    # rewrite only 2000Q1, with fewer rows
    save_vintage(one.limit(3), tmp_dir, "FNMA", "Loan")
    back = spark.read.parquet(path)
    assert back.where(F.col("ACQ") != "2000Q1").count() == n_all - one.count()
    assert back.where(F.col("ACQ") == "2000Q1").count() == 3
    assert os.path.isdir(_local(path) + "/ACQ=2000Q1")
    # pruning: the filter reaches the partition listing
    plan = back.where(F.col("ACQ") == "2000Q1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ACQ" in plan


def test_stage_literal_vintage(spark, tmp_dir):
    perf = fnma_performance(spark, SF0001).select("LOAN_ID", "LOAN_AGE")
    stage_to_vintage(perf, "2000Q1", tmp_dir + "/stage")
    back = spark.read.parquet(tmp_dir + "/stage")
    assert back.select("ACQ").distinct().collect()[0][0] == "2000Q1"
    assert back.count() == perf.count()


def test_parquet_and_catalog(spark, tmp_dir):
    loans = clean_acquisition(fnma_acquisition(spark, SF0001), FNMA)
    p = save_parquet(loans, tmp_dir + "/loans")
    assert _rows(spark.read.parquet(p)) == _rows(loans)
    name = save_table(spark, loans, "mortar_test_db", "loans_t", path=tmp_dir + "/tbl")
    assert spark.table(name).count() == loans.count()
    save_table(spark, loans.limit(5), "mortar_test_db", "loans_t", path=tmp_dir + "/tbl")
    assert spark.table(name).count() == 5  # replaced, not appended


def test_sorted_sink_is_ordered(spark, tmp_dir):
    loans = clean_acquisition(fnma_acquisition(spark, SF0001), FNMA).select("LOAN_ID")
    out = save_parquet(sorted_for_sink(loans, ["LOAN_ID"], 4), tmp_dir + "/sorted")
    files = sorted(f for f in os.listdir(_local(out)) if f.endswith(".parquet"))
    last = None
    for f in files:
        ids = [r[0] for r in spark.read.parquet(_local(out) + "/" + f).collect()]
        assert ids == sorted(ids)
        if last is not None and ids:
            assert last <= ids[0]
        if ids:
            last = ids[-1]


def test_save_build_by_vintage(spark, tmp_dir):
    from mortar.plans.loan_level import build, save
    lvl = build(fnma_performance(spark, SF0001), fnma_acquisition(spark, SF0001))
    p1 = save(lvl, tmp_dir, "2000Q1")
    p2 = save(lvl, tmp_dir, "2000Q2", performance=False)
    assert p1["Loan"] == p2["Loan"] and p1["Loan"].endswith("/FNMA/Loan.parquet")
    loans = spark.read.parquet(p1["Loan"])
    assert sorted(r[0] for r in loans.select("ACQ").distinct().collect()) == ["2000Q1", "2000Q2"]
    assert loans.where(F.col("ACQ") == "2000Q1").count() == lvl.outcome().count()
    perf = spark.read.parquet(p1["LoanPerformance"])
    assert perf.count() == lvl.performance().count()
    assert [r[0] for r in perf.select("ACQ").distinct().collect()] == ["2000Q1"]


def test_save_parquet_without_dictionary(spark, tmp_dir):
    from mortar.operators.schedule import PAYMENT_MONEY, payment_table
    loans = clean_acquisition(fnma_acquisition(spark, SF0001), FNMA).where(F.col("ORIG_TRM") < 12)
    pt = payment_table(loans)
    path = save_parquet(pt, tmp_dir + "/pay", no_dictionary=PAYMENT_MONEY)
    assert _rows(spark.read.parquet(path)) == _rows(pt)


def test_empty_rewrite_empties_only_its_vintage(spark, tmp_dir):
    loans = clean_acquisition(fnma_acquisition(spark, SF0001), FNMA)
    path = save_vintage(loans, tmp_dir, "FNMA", "Loan")
    save_vintage(loans.where("false"), tmp_dir, "FNMA", "Loan", "1995Q1")
    back = spark.read.parquet(path)
    assert back.where("ACQ = '1995Q1'").count() == 0
    assert back.count() == loans.where("ACQ <> '1995Q1'").count()


def test_files_per_vintage_follow_its_size(spark, tmp_dir):
    loans = clean_acquisition(fnma_acquisition(spark, SF0001), FNMA).repartition(16)
    path = save_vintage(loans, tmp_dir, "FNMA", "Loan")
    for folder in os.listdir(_local(path)):
        if folder.startswith("ACQ="):
            files = [f for f in os.listdir(f"{_local(path)}/{folder}") if f.endswith(".parquet")]
            assert len(files) == 1


def test_session_settings_stay_untouched(spark, tmp_dir):
    from mortar.plans.queries import QUERIES
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    QUERIES["write_vintage"](spark, SF0001).count()
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_save_reads_the_tape_once(spark, tmp_dir):
    from mortar.plans.loan_level import build, save
    from mortar.session import subfolders, checkpoint_root
    lvl = build(fnma_performance(spark, SF0001), fnma_acquisition(spark, SF0001))
    save(lvl, tmp_dir, "2000Q1")
    assert not [n for n in subfolders(spark, checkpoint_root(spark) + "/mortar") if n.startswith("save-months")]


def test_no_machine_local_scratch_on_a_cluster():
    import pytest
    from mortar.session import checkpoint_root

    class Conf:
        get = staticmethod(lambda key, default=None: default)

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        conf, sparkContext = Conf, Context

    with pytest.raises(RuntimeError):
        checkpoint_root(Session)
