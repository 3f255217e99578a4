"""WARC archives and their capture index.

Writing: every page becomes one record of a gzip WARC file.  Records with
equal payloads form a group; the one with the largest page_id is stored as
response, the others as revisit records that refer to it and hold no
payload.  Reading: the archives are split into records again, and every
stored payload is checked against its length and SHA-1 digest.

Index: every archive's captures are sorted locally by URL key and timestamp
(a run).  The runs are cut at common key ranges, and each range merges its
slices of all runs with a loser tree, so that the ranges in order are the
globally ordered capture histories.

Spark writes and reads all files; a range holds about ``RANGE_ROWS`` index
rows, also where one URL has most of the captures (timestamp and record id
are part of the range key).

Defined cases: a null html is the empty payload; a null url has the key
"-"; line breaks in a url are written as %0D and %0A; repeated rows are
records of their own (of two with the group's largest page_id both are
responses); a null page_id never names a response that others refer to;
payloads shorter than ``min_bytes`` are never deduplicated.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_path
from .text import cut, lookup

# Workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# --- fixed values: formats ----------------------------------------------------
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
END = "\r\n"
GAP = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# --- end of fixed values ------------------------------------------------------

# Pages carry no capture time: record n is dated n seconds after this.
FIRST_CAPTURE = "2020-01-01T00:00:00Z"
RECORDS_PER_FILE = 50_000
RANGE_ROWS = 100_000


def base32_of_hex(hex_digest: Column) -> Column:
    """Bare upper-case base32 of a hex digest whose length divides by five digits."""
    letters = F.lit(BASE32)

    def four(at: int) -> list[Column]:
        n = F.conv(F.substring(hex_digest, at, 5), 16, 10).cast("int")
        return [letters.substr(F.shiftright(n, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]

    return F.concat(*[c for at in range(1, 41, 5) for c in four(at)])


def url_key(url: Column) -> Column:
    """Host labels reversed, then path and query: ``org,example,www)/a?b``."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))
    rest = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^#]*)", 1)
    labels = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    return F.when(url.isNull(), F.lit("-")).when(host == "", url).otherwise(F.concat(labels, F.lit(")"), rest))


def classify(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, payload_bytes, payload_digest, record_type, refers_to)."""
    body = F.coalesce("html", F.lit(""))
    facts = pages.select(
        "page_id", "url", body.alias("html"), F.octet_length(body).cast("long").alias("payload_bytes"),
        F.sha1(body).alias("hex"))
    # equal SHA-1 alone can be forged, so the group key holds SHA-256 as well
    keyed = facts.withColumn("same", F.when(
        F.col("payload_bytes") >= min_bytes, F.concat("hex", F.substring(F.sha2("html", 256), 1, 24))))
    groups = cut(
        keyed.where(F.col("same").isNotNull()).groupBy("same")
        .agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("keeper")).where(F.col("n") > 1))
    typed = lookup(keyed, groups, "same", "n", [F.col("page_id"), F.col("url")])
    revisit = F.col("keeper").isNotNull() & ~F.col("keeper").eqNullSafe(F.col("page_id"))
    return typed.select(
        "page_id", "url", "html", "payload_bytes", base32_of_hex(F.col("hex")).alias("payload_digest"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("keeper")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, boundary: str, min_bytes: int = 0) -> None:
    """Write one record per page; ``boundary`` names the archive set in every record."""
    typed = classify(pages.select("page_id", "url", "html"), min_bytes)
    revisit = F.col("record_type") == "revisit"
    number = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    when = F.date_format(F.timestamp_seconds(
        F.unix_timestamp(F.to_timestamp(F.lit(FIRST_CAPTURE))) + F.coalesce("page_id", F.lit(0))),
        "yyyy-MM-dd'T'HH:mm:ss'Z'")

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(name + ": "), value, F.lit(END))

    http = F.concat(F.lit("HTTP/1.1 200 OK" + END), line("Content-Type", F.lit("text/html; charset=utf-8")),
                    line("Content-Length", F.col("payload_bytes").cast("string")), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    record = F.concat(
        F.lit(opening(boundary)),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), number, F.lit(">"))),
        F.when(F.col("url").isNotNull(), line("WARC-Target-URI", uri)).otherwise(F.lit("")),
        line("WARC-Date", when),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(REVISIT_PROFILE)), line(
            "WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        )).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(END), block)
    (typed.select(record.alias("value")).write.option("lineSep", GAP).option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(folder))


def opening(boundary: str) -> str:
    """The first lines of every record: no payload can hold the fresh boundary id."""
    return f"WARC/1.1{END}WARC-Warcinfo-ID: <urn:uuid:{boundary}>{END}"


def read_archives(spark: SparkSession, folder: str, boundary: str) -> DataFrame:
    """One row per record, payloads checked; a damaged record fails the read."""
    raw = spark.read.option("lineSep", opening(boundary)).text(folder).where(F.col("value") != "").select(
        "value", F.col("_metadata.file_name").alias("archive"))
    parts = raw.select("archive", F.split("value", GAP, 3).alias("p"))
    head, http = F.concat(F.lit("\n"), F.col("p")[0]), F.concat(F.lit("\n"), F.col("p")[1])

    def field(text: Column, name: str) -> Column:
        return F.regexp_extract(text, rf"\n{name}: ([^\r\n]*)", 1)

    def page(text: Column) -> Column:
        return F.nullif(F.regexp_extract(text, r"<urn:page:(-?\d*)>", 1), F.lit("")).cast("long")

    body = F.col("p")[2]
    rows = parts.select(
        page(field(head, "WARC-Record-ID")).alias("page_id"),
        F.nullif(field(head, "WARC-Target-URI"), F.lit("")).alias("url"),
        field(head, "WARC-Date").alias("captured"),
        field(head, "WARC-Type").alias("record_type"),
        page(field(head, "WARC-Refers-To")).alias("refers_to"),
        F.replace(field(head, "WARC-Payload-Digest"), F.lit("sha1:"), F.lit("")).alias("payload_digest"),
        field(http, "Content-Length").cast("long").alias("payload_bytes"),
        F.substring(body, F.lit(1), F.length(body) - len(GAP)).alias("payload"),
        "archive",
    )
    stored = F.col("record_type") == "response"
    whole = (F.octet_length("payload") == F.col("payload_bytes")) & (
        base32_of_hex(F.sha1("payload")) == F.col("payload_digest"))
    checked = F.when(~stored, F.lit(None).cast("string")).when(whole, F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("damaged record "), F.col("page_id").cast("string"))))
    return rows.withColumn("payload", checked)


class LoserTree:
    """K-way merge of sorted lists: one comparison a level for every item taken."""

    def __init__(self, runs: list[list]):
        self.runs = [r for r in runs if r]
        self.at = [0] * len(self.runs)
        self.k = len(self.runs)
        self.losers = [-1] * self.k
        self.winner = self._play(1) if self.k > 1 else 0

    def _beats(self, a: int, b: int) -> bool:
        """Whether run a's next item comes before run b's; a finished run loses."""
        if self.at[a] >= len(self.runs[a]):
            return False
        if self.at[b] >= len(self.runs[b]):
            return True
        x, y = self.runs[a][self.at[a]], self.runs[b][self.at[b]]
        return x < y or (x == y and a < b)

    def _play(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        left, right = self._play(2 * node), self._play(2 * node + 1)
        winner, loser = (left, right) if self._beats(left, right) else (right, left)
        self.losers[node] = loser
        return winner

    def __iter__(self):
        for _ in range(sum(map(len, self.runs))):
            run = self.winner
            yield self.runs[run][self.at[run]]
            self.at[run] += 1
            node = (run + self.k) // 2
            while node >= 1 and self.k > 1:
                if self._beats(self.losers[node], run):
                    self.losers[node], run = run, self.losers[node]
                node //= 2
            self.winner = run


def _merge_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One key range: its slices of all runs, in run order, merged by (urlkey, captured, page_id)."""
    table = [b for b in batches if b.num_rows]
    if not table:
        return
    whole = pa.Table.from_batches(table)
    run_of = whole.column("run").to_pylist()
    keys = zip(whole.column("urlkey").to_pylist(), whole.column("captured").to_pylist(),
               [(i is not None, i or 0) for i in whole.column("page_id").to_pylist()])
    runs: list[list] = []
    for row, (run, key) in enumerate(zip(run_of, keys)):
        if not row or run != run_of[row - 1]:
            runs.append([])
        runs[-1].append((*key, row))
    order = pa.array([item[-1] for item in LoserTree(runs)], pa.int64())
    yield from whole.take(order).combine_chunks().to_batches()


def merge_index(records: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Capture index in global (urlkey, captured, page_id) order; ``position`` keeps the order."""
    spark = records.sparkSession
    key = ["urlkey", "captured", "page_id"]
    rows = records.withColumn("urlkey", url_key(F.col("url"))).drop("payload")
    path = scratch_path(spark, "capture-runs")
    rows.sortWithinPartitions(*key).withColumn("seq", F.monotonically_increasing_id()).write.parquet(path)
    runs = spark.read.parquet(path).withColumn("run", F.shiftright("seq", 33))
    ranges = max(1, -(-runs.count() // range_rows))
    sliced = runs.repartitionByRange(ranges, *key).sortWithinPartitions("run", "seq")
    return sliced.mapInArrow(_merge_ranges, sliced.schema).withColumn(
        "position", F.monotonically_increasing_id()).drop("run", "seq")


def archive(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write, read back and index ``pages``: the merged index with record facts."""
    spark = pages.sparkSession
    folder, boundary = scratch_path(spark, "warc"), str(uuid.uuid4())
    write_archives(pages, folder, boundary, min_bytes)
    return merge_index(read_archives(spark, folder, boundary))


def record_digest(pages: DataFrame) -> DataFrame:
    """The contract's columns, plus urlkey and position."""
    return archive(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                                 "urlkey", "position")
