"""Versioned monthly table: batches of Parquet and a manifest that says which count.

A batch (rows landed together) is a folder ``data/batch=<name>`` below the
table.  Nothing is visible until a manifest lists it: ``_manifest/<n>.json``,
written beside and renamed into place, so that version n exists once or not at
all.  A reader takes the last manifest and reads the batches that it lists; a
commit in between changes neither its files nor its result.  Batches are added
(``append``), replace the rows of their own keys (``upsert``: a restated
quarter) or take the place of everything (``replace``): each is one manifest.

Reading resolves restated rows: a row counts if no later upsert holds its key.
The newest upsert of a key is a partial aggregate over the upserts alone, and
meets the rows by equality, one row a key.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import remove_path, subfolders

KEYS = ("LOAN_ID", "ACT_DTE")
MODES = ("append", "upsert", "replace")
_BATCH = "batch"
EMPTY = {"version": 0, "batches": [], "sources": {}}


def _folder(table: str, *parts: str) -> str:
    return "/".join([table.rstrip("/"), *parts])


def batch_path(table: str, name: str) -> str:
    return _folder(table, "data", f"{_BATCH}={name}")


def stage_batch(df: DataFrame, table: str, name: str | None = None) -> str:
    """Write a batch that nobody sees yet; its name (a rewrite of the name replaces its files)."""
    name = name or f"b{uuid.uuid4().hex}"  # a letter first: never read as a number
    df.write.mode("overwrite").parquet(batch_path(table, name))
    return name


def _manifests(spark: SparkSession, table: str) -> list[str]:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(_folder(table, "_manifest"))
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(hadoop)]
    return sorted(n for n in names if n.endswith(".json") and not n.startswith("."))


def manifest(spark: SparkSession, table: str, version: int | None = None) -> dict:
    """The last manifest, or that of an older version."""
    names = _manifests(spark, table) if version is None else [f"{version:020d}.json"]
    if not names:
        return EMPTY
    text = spark.read.text(_folder(table, "_manifest", names[-1]), wholetext=True).first()[0]
    return json.loads(text)


def _put(spark: SparkSession, table: str, content: dict) -> bool:
    """Write version n of the manifest; False if another writer was first."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder = _folder(table, "_manifest")
    temporary = jvm.org.apache.hadoop.fs.Path(f"{folder}/.{uuid.uuid4().hex}")
    final = jvm.org.apache.hadoop.fs.Path(f"{folder}/{content['version']:020d}.json")
    fs = temporary.getFileSystem(conf)
    out = fs.create(temporary, True)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    # a FileContext rename fails where the name is taken, on every file system
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    kinds = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(temporary), fs.makeQualified(final), kinds)
    except Exception as e:  # noqa: BLE001 - Py4J wraps the Java exception
        fs.delete(temporary, False)
        if "FileAlreadyExistsException" in str(e):
            return False
        raise
    return True


def commit(spark: SparkSession, table: str, names: Sequence[str], mode: str = "append",
           sources: dict[str, int] | None = None, attempts: int = 20) -> int:
    """Make staged batches count, all at once; the version that does.

    ``sources`` notes how far a source has been committed.  A commit that
    another writer beat is made again on top of the other's.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {', '.join(MODES)}, not {mode!r}")
    for _ in range(attempts):
        old = manifest(spark, table)
        kept = [] if mode == "replace" else old["batches"]
        number = old["version"] + 1
        new = [{"name": n, "number": number, "upsert": mode == "upsert"} for n in names]
        if _put(spark, table, {"version": number, "batches": kept + new, "sources": {**old["sources"], **(sources or {})}}):
            return number
    raise RuntimeError(f"{attempts} commits to {table} were beaten by others")


def save_batch(df: DataFrame, table: str, mode: str = "append") -> int:
    """Stage and commit one batch."""
    return commit(df.sparkSession, table, [stage_batch(df, table)], mode)


def read_versions(spark: SparkSession, table: str, keys: Sequence[str] = KEYS, version: int | None = None) -> DataFrame:
    """The rows that count in the last (or an older) version.

    A key that an upsert holds counts with the rows of the last upsert that
    holds it, all of them; rows with a null in their key are never replaced.
    """
    listed = manifest(spark, table, version)["batches"]
    if not listed:
        raise ValueError(f"nothing is committed in {table}")
    rows = spark.read.option("basePath", _folder(table, "data")).option("mergeSchema", "true").parquet(
        *[batch_path(table, b["name"]) for b in listed])
    number = {b["name"]: b["number"] for b in listed}
    upserts = [b["name"] for b in listed if b["upsert"] and b["number"] > min(number.values())]
    if not upserts:
        return rows.drop(_BATCH)
    of = F.create_map(*[F.lit(x) for pair in number.items() for x in pair])
    rows = rows.withColumn(_BATCH, F.col(_BATCH).cast("string"))
    numbered = rows.withColumn("_number", of[F.col(_BATCH)])
    newest = numbered.where(F.col(_BATCH).isin(upserts)).groupBy(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.max("_number").alias("_newest"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & (F.col(k) == F.col(f"_k{i}"))
    joined = numbered.join(newest, same, "left").where(
        F.col("_newest").isNull() | (F.col("_number") >= F.col("_newest")))
    return joined.select(*[c for c in rows.columns if c != _BATCH])


def compact(spark: SparkSession, table: str, keys: Sequence[str] = KEYS) -> int:
    """Write the rows that count as one batch and commit it in place of all others.

    The caller keeps other writers away: what they commit meanwhile would be
    replaced; such a commit makes this one fail.
    """
    old = manifest(spark, table)
    name = stage_batch(read_versions(spark, table, keys, old["version"]), table)
    number = old["version"] + 1
    if not _put(spark, table, {**old, "version": number, "batches": [{"name": name, "number": number, "upsert": False}]}):
        raise RuntimeError(f"{table} was changed during the compaction")
    return number


def vacuum(spark: SparkSession, table: str, keep: int = 2) -> list[str]:
    """Delete manifests but the last ``keep`` and batches that only those listed; the deleted batches.

    Staged batches of a running ingest are newer than the last manifest and
    belong to no version: they stay.
    """
    names = _manifests(spark, table)
    old, kept = names[:-keep], names[-keep:]

    def listed(some: list[str]) -> set[str]:
        return {b["name"] for n in some for b in manifest(spark, table, int(n[:-5]))["batches"]}
    gone = sorted(listed(old) - listed(kept))
    for n in old:
        remove_path(spark, _folder(table, "_manifest", n))
    for n in gone:
        remove_path(spark, batch_path(table, n))
    return gone


def staged_batches(spark: SparkSession, table: str) -> list[str]:
    """Names of all batch folders, committed or not."""
    return [n.split("=", 1)[1] for n in subfolders(spark, _folder(table, "data")) if n.startswith(_BATCH + "=")]
