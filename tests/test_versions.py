"""Versioned table: restated keys, one manifest a commit, readers between commits."""

import pytest
from pyspark.sql import functions as F

from mortar.schema import FNMA
from mortar.sinks.versions import (
    batch_path, commit, compact, manifest, read_versions, save_batch, stage_batch, staged_batches, vacuum,
)
from mortar.sources.fixtures import fnma_performance
from mortar.sources.text import write_tape
from mortar.streaming.restate import ingest_versions

from conftest import SF0001

SCHEMA = "LOAN_ID string, ACT_DTE int, V int"


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def test_upserts_replace_their_own_keys_only(spark, tmp_dir):
    first = [("a", 1, 10), ("a", 2, 20), ("b", 1, 5), (None, 1, 1), ("a", 1, 11)]
    save_batch(spark.createDataFrame(first, SCHEMA), tmp_dir)
    save_batch(spark.createDataFrame([("a", 2, 21), ("a", 2, 22), ("c", 1, 7), (None, 1, 3)], SCHEMA), tmp_dir, "upsert")
    save_batch(spark.createDataFrame([("a", 2, 99), ("d", 1, 1)], SCHEMA), tmp_dir)  # added, not restated
    save_batch(spark.createDataFrame([("c", 1, 8)], SCHEMA), tmp_dir, "upsert")
    want = sorted([("a", 1, 10), ("a", 1, 11), ("a", 2, 21), ("a", 2, 22), ("a", 2, 99), ("b", 1, 5), ("c", 1, 8), ("d", 1, 1),
                   (None, 1, 1), (None, 1, 3)], key=str)
    assert rows(read_versions(spark, tmp_dir)) == want
    assert rows(read_versions(spark, tmp_dir, version=1)) == sorted(first, key=str)
    assert compact(spark, tmp_dir) == 5
    assert rows(read_versions(spark, tmp_dir)) == want and len(manifest(spark, tmp_dir)["batches"]) == 1
    assert len(vacuum(spark, tmp_dir, keep=1)) == 4
    assert rows(read_versions(spark, tmp_dir)) == want


def test_a_reader_sees_the_old_or_the_new_state(spark, tmp_dir):
    save_batch(spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], SCHEMA), tmp_dir)
    before = read_versions(spark, tmp_dir)
    names = [stage_batch(spark.createDataFrame([(k, 1, 2)], SCHEMA), tmp_dir) for k in "ab"]
    assert rows(read_versions(spark, tmp_dir)) == [("a", 1, 1), ("b", 1, 1)]  # staged is not committed
    commit(spark, tmp_dir, names, "replace")
    assert rows(read_versions(spark, tmp_dir)) == [("a", 1, 2), ("b", 1, 2)]
    assert rows(before) == [("a", 1, 1), ("b", 1, 1)]  # a plan made before reads what it listed
    with pytest.raises(ValueError):
        commit(spark, tmp_dir, names, "merge")
    with pytest.raises(ValueError):
        read_versions(spark, tmp_dir + "/none")


def test_a_beaten_commit_is_made_again(spark, tmp_dir, monkeypatch):
    from mortar.sinks import versions
    save_batch(spark.createDataFrame([("a", 1, 1)], SCHEMA), tmp_dir)
    other, put = stage_batch(spark.createDataFrame([("b", 1, 2)], SCHEMA), tmp_dir), versions._put
    beaten = []

    def slow(spark_, table, content):
        if not beaten:
            beaten.append(content["version"])
            monkeypatch.setattr(versions, "_put", put)
            commit(spark_, table, [other], "append")  # another writer comes first
        return put(spark_, table, content)
    monkeypatch.setattr(versions, "_put", slow)
    assert save_batch(spark.createDataFrame([("c", 1, 3)], SCHEMA), tmp_dir) == 3 and beaten == [2]
    assert rows(read_versions(spark, tmp_dir)) == [("a", 1, 1), ("b", 1, 2), ("c", 1, 3)]


def test_ingest_appends_restates_and_replaces(spark, tmp_dir):
    perf = fnma_performance(spark, SF0001)
    table, landing = tmp_dir + "/table", tmp_dir + "/landing"

    def land(df, name, mode, ckpt):
        write_tape(df, f"{landing}-{ckpt}/{name}", FNMA.performance, num_files=2)
        return ingest_versions(spark, f"{landing}-{ckpt}/*", table, f"{tmp_dir}/ckpt-{ckpt}", FNMA, mode, max_files_per_trigger=1)
    assert land(perf.where("LOAN_AGE < 20"), "one", "append", "a") == 1
    assert land(perf.where("LOAN_AGE >= 20"), "two", "append", "a") == 2
    assert ingest_versions(spark, f"{landing}-a/*", table, f"{tmp_dir}/ckpt-a", FNMA) == 2  # nothing new, no commit
    assert read_versions(spark, table).count() == perf.count()
    months = perf.where("LOAN_AGE between 5 and 9").withColumn("LAST_UPB", F.lit(-1.0))
    assert land(months, "again", "upsert", "b") == 3
    now = read_versions(spark, table)
    assert now.count() == perf.count() and now.where("LAST_UPB = -1").count() == months.count()
    # the same source replaces what it landed itself, too
    assert land(perf.limit(7), "new", "replace", "a") == 4
    assert read_versions(spark, table).count() == 7


def test_a_run_that_died_before_its_commit_is_committed_by_the_next(spark, tmp_dir, monkeypatch):
    from mortar.streaming import restate
    perf = fnma_performance(spark, SF0001)
    write_tape(perf, tmp_dir + "/landing", FNMA.performance)
    args = (spark, tmp_dir + "/landing", tmp_dir + "/table", tmp_dir + "/ckpt", FNMA)

    def dies(*_a, **_k):
        raise RuntimeError("lost")
    monkeypatch.setattr(restate, "commit", dies)
    with pytest.raises(RuntimeError, match="lost"):
        ingest_versions(*args)
    assert staged_batches(spark, tmp_dir + "/table") and manifest(spark, tmp_dir + "/table")["version"] == 0
    monkeypatch.undo()
    assert ingest_versions(*args) == 1
    assert read_versions(spark, tmp_dir + "/table").count() == perf.count()
    assert batch_path("t/", "x") == "t/data/batch=x"
