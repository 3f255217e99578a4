"""Headerless ``|``-delimited tapes: scan with a declared schema, and write.

The scan never infers: the schema registry gives every column's type, and
date columns are read as text and parsed by their own pattern afterwards.
Uncompressed text is split by ``spark.sql.files.maxPartitionBytes``, so a
large tape spreads over the cluster without any work here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..operators.clean import clean_acquisition, clean_performance
from ..schema import Agency, TapeSchema, agency as agency_of

CORRUPT = "_corrupt_record"


def _agency(a: str | Agency) -> Agency:
    return a if isinstance(a, Agency) else agency_of(a)


def tape_reader(spark: SparkSession, tape: TapeSchema, with_corrupt: bool = False):
    schema = tape.read_struct()
    if with_corrupt:
        schema = schema.add(T.StructField(CORRUPT, T.StringType(), True))
    reader = (
        spark.read.schema(schema)
        .option("sep", "|")
        .option("header", "false")
        .option("mode", "PERMISSIVE")
    )
    if with_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader


def read_tape(spark: SparkSession, path: str, tape: TapeSchema) -> DataFrame:
    """S1/S2 raw scan: declared types, dates still text, blank -> null."""
    return tape_reader(spark, tape).csv(path)


def rejected_rows(spark: SparkSession, path: str, tape: TapeSchema) -> DataFrame:
    """Rows the parser could not fit to the schema (short rows, bad numbers).

    All parsed columns are kept beside the raw text: Spark refuses a scan
    whose only referenced column is the corrupt-record column.
    """
    df = tape_reader(spark, tape, with_corrupt=True).csv(path)
    return df.where(F.col(CORRUPT).isNotNull())


def read_acquisition(spark: SparkSession, path: str, agency: str | Agency = "FNMA") -> DataFrame:
    """S1 + P1-P4: the cleaned loan tape."""
    ag = _agency(agency)
    return clean_acquisition(read_tape(spark, path, ag.acquisition), ag)


def read_performance(spark: SparkSession, path: str, agency: str | Agency = "FNMA") -> DataFrame:
    """S2 + P1, P5, P6, F1: the cleaned monthly tape (simple path)."""
    ag = _agency(agency)
    return clean_performance(read_tape(spark, path, ag.performance), ag)


def format_tape(df: DataFrame, tape: TapeSchema) -> DataFrame:
    """Render a typed tape as the text columns of its file, in file order."""
    cols = []
    for spec in tape.columns:
        c = F.col(spec.name)
        if spec.dtype == "date":
            cols.append(F.date_format(c, spec.pattern).alias(spec.name))
        else:
            cols.append(c.cast("string").alias(spec.name))
    return df.select(*cols)


def write_tape(df: DataFrame, path: str, tape: TapeSchema, mode: str = "overwrite",
               num_files: int | None = None) -> str:
    """Write a typed tape as headerless ``|`` text (null -> empty field)."""
    out = format_tape(df, tape)
    if num_files is not None:
        out = out.repartition(num_files)
    out.write.mode(mode).option("sep", "|").option("header", "false").csv(path)
    return path
