"""Ingest of landed tape files into a versioned table: append, restate, replace.

Each micro-batch of the file stream is staged as a batch of
``sinks.versions`` under a name made of its source and epoch, so a micro-batch
that runs again after a failure overwrites its own files.  When the stream has
taken all files, everything it staged is committed by one manifest: readers
see the table before the run or after it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schema import Agency
from ..sinks.parquet import VINTAGE
from ..sinks.versions import MODES, commit, manifest, stage_batch, staged_batches
from .ingest import landing_stream


def _source(checkpoint_dir: str) -> str:
    return "s" + hashlib.sha256(checkpoint_dir.rstrip("/").encode()).hexdigest()[:16]


def ingest_versions(spark: SparkSession, source_dir: str, table: str, checkpoint_dir: str, agency: str | Agency = "FNMA",
                    mode: str = "append", vintage: str | None = None, max_files_per_trigger: int | None = None,
                    max_bytes_per_trigger: str | None = None) -> int:
    """Take every file that has arrived, then commit; the version after it.

    ``append`` adds the rows, ``upsert`` replaces the rows of the same
    (LOAN_ID, ACT_DTE) (restated months), ``replace`` leaves this run's rows
    only, those that the same source landed before included.  A run that
    finds no new file commits nothing.  A run that died after staging is
    committed by the next run with the same checkpoint.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {', '.join(MODES)}, not {mode!r}")
    source = _source(checkpoint_dir)
    stream = landing_stream(spark, source_dir, agency, max_files_per_trigger, max_bytes_per_trigger)
    if vintage is not None:
        stream = stream.withColumn(VINTAGE, F.lit(vintage))

    def stage(batch: DataFrame, epoch: int) -> None:
        stage_batch(batch, table, f"{source}-{epoch:010d}")
    query = stream.writeStream.foreachBatch(stage).option("checkpointLocation", checkpoint_dir).trigger(
        availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    now = manifest(spark, table)
    done = now["sources"].get(source, -1)
    new = [n for n in staged_batches(spark, table) if n.startswith(source + "-") and int(n.rsplit("-", 1)[1]) > done]
    if not new:
        return now["version"]
    return commit(spark, table, new, mode, {source: int(new[-1].rsplit("-", 1)[1])})
