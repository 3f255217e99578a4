"""Parquet and catalog sinks.

Vintage layout: ``<folder>/<agency>/<table>.parquet/ACQ=<YYYYQn>``.  Writing
a vintage replaces only that vintage's folder and leaves the others in place.
Overwrite modes are set on each write; the session's are never changed.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

VINTAGE = "ACQ"
_VINTAGE = re.compile(r"^[A-Za-z0-9]+$")
_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def sorted_for_sink(df: DataFrame, keys: list[str], partitions: int | None = None,
                    total_order: bool = True) -> DataFrame:
    """O1/O2 at the sink.

    ``total_order``: range-partition then sort inside each partition, which
    gives globally ordered files without funnelling rows through one task,
    at the price of a full range shuffle.  Otherwise each task's output is
    sorted in place (no shuffle): files are clustered by the keys, which is
    what Parquet min/max pruning needs, and a frame that is already
    hash-partitioned by ``LOAN_ID`` keeps every loan in one file.
    """
    if not total_order:
        return df.sortWithinPartitions(*keys)
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def save_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                 no_dictionary: list[str] | tuple[str, ...] = ()) -> str:
    """Write one table to a given path.

    ``no_dictionary`` names high-entropy columns (computed balances and
    amounts) for which the writer should skip the dictionary it would build
    and then abandon.
    """
    writer = df.write.mode(mode)
    for c in no_dictionary:
        writer = writer.option(f"parquet.enable.dictionary#{c}", "false")
    writer.parquet(path)
    return path


def vintage_path(folder: str, agency: str, table: str) -> str:
    return f"{folder.rstrip('/')}/{agency}/{table}.parquet"


def save_vintage(df: DataFrame, folder: str, agency: str, table: str,
                 vintage: str | None = None) -> str:
    """Write by vintage, replacing only the vintages present in ``df``.

    With ``vintage`` given (one quarter's file), exactly that vintage is
    replaced, also by an empty ``df``; otherwise ``df`` must carry ``ACQ``,
    and its rows are first brought together by vintage, so that a vintage's
    files are as many as its size asks for, not as many as there are tasks.
    """
    path = vintage_path(folder, agency, table)
    if vintage is not None:
        return write_one_vintage(df, vintage, path)
    (
        df.hint("rebalance", F.col(VINTAGE)).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(VINTAGE)
        .parquet(path)
    )
    return path


def write_one_vintage(df: DataFrame, vintage: str, path: str) -> str:
    """Overwrite ``<path>/ACQ=<vintage>`` with the rows of ``df``, none included."""
    if not _VINTAGE.match(vintage):
        raise ValueError(f"not a vintage: {vintage!r}")
    df.drop(VINTAGE).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
        f"{path.rstrip('/')}/{VINTAGE}={vintage}")
    return path


def stage_to_vintage(staged: DataFrame, vintage: str, path: str) -> str:
    """S6 + P12: the staged monthly table under ``ACQ=<vintage>``, replacing what was there."""
    return write_one_vintage(staged, vintage, path)


def _ensure_database(spark: SparkSession, database: str, table: str, path: str | None) -> str:
    for n in (database, table):
        if not _NAME.match(n):
            raise ValueError(f"not a plain identifier: {n!r}")
    if path is not None:
        # a new database is kept beside its tables in the shared folder
        location = path.rstrip("/").rsplit("/", 1)[0] + f"/{database}.db"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    else:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    return f"{database}.{table}"


def save_table(spark: SparkSession, df: DataFrame, database: str, table: str,
               path: str | None = None) -> str:
    """Create the database if missing and (re)write ``database.table``.

    With ``path`` the table is external at that location (a shared folder),
    otherwise it lands in the session's warehouse.
    """
    name = _ensure_database(spark, database, table, path)
    writer = df.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return name


def save_bucketed(spark: SparkSession, df: DataFrame, database: str, table: str, buckets: int,
                  key: str = "LOAN_ID", sort_by: list[str] | None = None, path: str | None = None) -> str:
    """Catalog table bucketed (and optionally sorted) by ``key``.

    Jobs that later window or join on ``key`` read the buckets as already
    hash-partitioned, so the panel's exchange is paid once at write time
    instead of on every run.  Tables to be joined should share the bucket
    count.
    """
    name = _ensure_database(spark, database, table, path)
    writer = df.write.mode("overwrite").format("parquet").bucketBy(buckets, key)
    if sort_by:
        writer = writer.sortBy(*sort_by)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return name
