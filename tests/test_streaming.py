import pytest
from pyspark.sql import functions as F

from mortar.schema import FNMA
from mortar.sources.fixtures import fnma_performance
from mortar.sources.text import write_tape
from mortar.streaming.ingest import ingest_incremental, read_staged

from conftest import SF0001


def test_incremental_ingest_picks_up_only_new_files(spark, tmp_dir):
    perf = fnma_performance(spark, SF0001)
    early, late = perf.where(F.col("LOAN_AGE") < 20), perf.where(F.col("LOAN_AGE") >= 20)
    landing, target, ckpt = tmp_dir + "/landing", tmp_dir + "/staged", tmp_dir + "/ckpt"
    write_tape(early, landing + "/batch1", FNMA.performance, num_files=2)
    ingest_incremental(spark, landing + "/*", target, ckpt, "FNMA", 1)
    assert read_staged(spark, target).count() == early.count()
    write_tape(late, landing + "/batch2", FNMA.performance, num_files=2)
    ingest_incremental(spark, landing + "/*", target, ckpt, "FNMA", 1)
    staged = read_staged(spark, target)
    assert staged.count() == perf.count()  # no file read twice, none lost
    assert staged.where(F.col("Months_To_Legal_Mat").isNull()).count() == 0  # defaults filled
    assert dict(staged.dtypes)["ACT_DTE"] == "date"


def test_two_quarters_into_one_table(spark, tmp_dir):
    perf = fnma_performance(spark, SF0001)
    target, n = tmp_dir + "/staged", perf.count()
    for q in ("2000Q1", "2000Q2"):
        write_tape(perf, f"{tmp_dir}/{q}", FNMA.performance)
        ingest_incremental(spark, f"{tmp_dir}/{q}", target, f"{tmp_dir}/ckpt-{q}", vintage=q)
    assert {r.ACQ: r["count"] for r in read_staged(spark, target).groupBy("ACQ").count().collect()} == {
        "2000Q1": n, "2000Q2": n}
    ingest_incremental(spark, tmp_dir + "/2000Q2", target, tmp_dir + "/ckpt-2000Q2", vintage="2000Q2")
    assert read_staged(spark, target).count() == 2 * n  # a rerun adds nothing
    with pytest.raises(ValueError):
        read_staged(spark, tmp_dir + "/nothing")
