from dataclasses import replace

from mortar.plans.loan_level import build
from mortar.schema import FNMA
from mortar.sources.text import read_tape, write_tape
from mortar.sources.fixtures import fnma_acquisition, fnma_performance

from conftest import SF0001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _level(spark, tmp_dir):
    write_tape(fnma_acquisition(spark, SF0001), tmp_dir + "/acq", FNMA.acquisition)
    write_tape(fnma_performance(spark, SF0001), tmp_dir + "/perf", FNMA.performance)
    return build(read_tape(spark, tmp_dir + "/perf", FNMA.performance),
                 read_tape(spark, tmp_dir + "/acq", FNMA.acquisition), FNMA, 12)


def test_eight_windows_one_exchange(spark, tmp_dir):
    lvl = _level(spark, tmp_dir)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(lvl.panel)
        assert plan.count("Exchange hashpartitioning") == 1
        assert plan.count("Window [") == 1
        outcome = _plan(lvl.outcome())
        # the panel is shuffled once; the loan side at most once more
        assert outcome.count("Exchange hashpartitioning(LOAN_ID") <= 2
        assert "ArrowEvalPython" not in outcome and "BatchEvalPython" not in outcome
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_scan_prunes_columns(spark, tmp_dir):
    lvl = _level(spark, tmp_dir)
    plan = _plan(lvl.panel.select("LOAN_ID", "ACT_DTE", "DLQ_NEXT12MAX"))
    read_schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "SERVICER" not in read_schema and "FCC_COST" not in read_schema
    assert "DLQ_STATUS" in read_schema


def test_schedule_has_no_python_and_no_schedule_join(spark, tmp_dir):
    lvl = _level(spark, tmp_dir)
    plan = _plan(lvl.performance())
    assert "Generate" not in plan  # no exploded schedule to join
    assert "Python" not in plan


def test_bucketed_panel_needs_no_exchange(spark, tmp_dir):
    from mortar.operators.panel import enrich_panel
    from mortar.sinks.parquet import save_bucketed
    lvl = _level(spark, tmp_dir)
    name = save_bucketed(spark, lvl.perf_base, "mortar_test_db", "perf_bucketed", 4, "LOAN_ID",
                         ["ACT_DTE", "LOAN_AGE"], path=tmp_dir + "/bucketed")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(enrich_panel(spark.table(name), hot_threshold=None))
        assert "Exchange" not in plan and "Window [" in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_bucketed_tables_join_without_exchange(spark, tmp_dir):
    from mortar.operators.clean import keep_columns
    from mortar.operators.schedule import scheduled_balance_at_age
    from mortar.sinks.parquet import save_bucketed
    lvl = _level(spark, tmp_dir)
    panel = save_bucketed(spark, keep_columns(lvl.perf_base, FNMA.performance), "mortar_test_db", "pb_panel", 4,
                          "LOAN_ID", ["ACT_DTE", "LOAN_AGE"], path=tmp_dir + "/pb_panel")
    loans = save_bucketed(spark, lvl.loans, "mortar_test_db", "pb_loans", 4, "LOAN_ID", path=tmp_dir + "/pb_loans")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = scheduled_balance_at_age(spark.table(panel), spark.table(loans), 12)
        plan = _plan(joined)
        assert "SortMergeJoin" in plan
        assert "Exchange hashpartitioning" not in plan  # both sides read co-partitioned buckets
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_outcome_adds_few_exchanges(spark, tmp_dir):
    lvl = _level(spark, tmp_dir)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = _plan(lvl.outcome()).count("Exchange hashpartitioning")
        hot = replace(lvl, hot_threshold=60, chunk_rows=25)
        plan = _plan(hot.outcome())
        assert hot.n_hot > 0
        # the hot loans' own aggregate and join read a checkpoint; the panel is planned once
        assert plan.count("Exchange hashpartitioning") <= plain + 6
        assert plan.count("FileScan csv") <= 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_event_universe_is_one_scan_without_windows(spark, tmp_dir):
    plan = _plan(_level(spark, tmp_dir).universe)
    assert plan.count("FileScan csv") == 1 and "Window" not in plan
