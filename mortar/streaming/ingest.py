"""Incremental ingest of monthly tape files with Structured Streaming.

New ``|`` files dropped into a landing folder are picked up, cleaned like the
chunked reader (dates parsed, declared defaults filled) and appended to a
Parquet staging table.

Every source (landing folder with its checkpoint) writes to a folder of its
own below the staging table, ``<target>/source=<id of the checkpoint>``.  The
file sink keeps its log of committed batches there, so sources never mistake
each other's batches for their own, and a retried batch is never counted
twice.  Read the table with ``read_staged``, which sees committed files only.

Row-frame windows do not run on a stream, so the window features run in
batch over the landed table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.clean import staged_performance
from ..schema import Agency, agency as agency_of
from ..session import subfolders
from ..sinks.parquet import VINTAGE

_SOURCE = "source="


def landing_stream(spark: SparkSession, source_dir: str, agency: str | Agency = "FNMA",
                   max_files_per_trigger: int | None = None, max_bytes_per_trigger: str | None = None,
                   clean: Callable[[DataFrame, Agency], DataFrame] = staged_performance) -> DataFrame:
    """The landed files as a stream, cleaned; the limits cut it into batches (default: one batch)."""
    ag = agency if isinstance(agency, Agency) else agency_of(agency)
    reader = (
        spark.readStream.schema(ag.performance.read_struct())
        .option("sep", "|")
        .option("header", "false")
        .option("mode", "PERMISSIVE")
    )
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return clean(reader.csv(source_dir), ag)


def source_folder(target_dir: str, checkpoint_dir: str) -> str:
    name = hashlib.sha256(checkpoint_dir.rstrip("/").encode()).hexdigest()[:16]
    return f"{target_dir.rstrip('/')}/{_SOURCE}{name}"


def ingest_incremental(spark: SparkSession, source_dir: str, target_dir: str, checkpoint_dir: str,
                       agency: str | Agency = "FNMA", max_files_per_trigger: int | None = None,
                       vintage: str | None = None, max_bytes_per_trigger: str | None = None) -> str:
    """Process every file present now, in batches, then stop.

    Re-running with the same checkpoint picks up only files that arrived
    since.  Rows are added to what other sources landed (``restate`` has the
    ingest that replaces).  With ``vintage`` the rows also carry ``ACQ`` and
    land in that layout (S5 + S6 in one stream).
    """
    stream = landing_stream(spark, source_dir, agency, max_files_per_trigger, max_bytes_per_trigger)
    if vintage is not None:
        stream = stream.withColumn(VINTAGE, F.lit(vintage))
    own = source_folder(target_dir, checkpoint_dir)
    writer = stream.writeStream.format("parquet")
    if vintage is not None:
        writer = writer.partitionBy(VINTAGE)
    query = (
        writer.option("path", own)
        .option("checkpointLocation", checkpoint_dir)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return target_dir


def read_staged(spark: SparkSession, target_dir: str) -> DataFrame:
    """The committed rows of every source of a staging table."""
    names = [n for n in subfolders(spark, target_dir) if n.startswith(_SOURCE)]
    if not names:
        raise ValueError(f"nothing was landed in {target_dir}")
    parts = [spark.read.parquet(f"{target_dir.rstrip('/')}/{n}") for n in names]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
