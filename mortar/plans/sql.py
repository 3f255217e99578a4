"""SQL entry: the operators as SQL functions of the catalog.

Plain SQL text can use them like any function; they are SQL bodies, so
Catalyst inlines them and no Python worker runs.  ``loan_schedule`` is a table
function for ``LATERAL``; Spark resolves table functions in the current
database only (``USE`` the one they were created in).
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

from ..functions.amortize import BEYOND_TERM
from ..functions.cleaning import DLQ_REO, DLQ_REO_TEXT, DLQ_UNKNOWN
from ..operators.market import TERM_BUCKETS

_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _bucket() -> str:
    cases = " ".join(f"WHEN term <= {n} THEN {n}" for n in TERM_BUCKETS[:-1])
    return f"CASE WHEN term <= 0 OR term IS NULL THEN NULL {cases} ELSE {TERM_BUCKETS[-1]} END"


def _bodies(q: str) -> dict[str, str]:
    """Function signature -> body; ``q`` qualifies calls among them."""
    return {
        "channel_bucket(channel STRING) RETURNS STRING":
            "CASE WHEN channel IN ('R', 'C') THEN 'R1' WHEN channel = 'B' THEN 'B1' ELSE channel END",
        "dlq_status(status STRING) RETURNS INT":
            f"CASE WHEN status IS NULL THEN {DLQ_UNKNOWN} WHEN status = '{DLQ_REO_TEXT}' THEN {DLQ_REO} "
            "ELSE try_cast(status AS INT) END",
        "term_bucket(term INT) RETURNS INT": _bucket(),
        "monthly_rate(rate DOUBLE) RETURNS DOUBLE": "rate / 1200.0D",
        "level_payment(amount DOUBLE, rate DOUBLE, term INT) RETURNS DOUBLE":
            "CASE WHEN term > 0 THEN CASE WHEN rate = 0 THEN amount / term "
            "ELSE amount * try_divide(rate / 1200.0D, 1.0D - pow(1.0D + rate / 1200.0D, -term)) END END",
        "balance_after(amount DOUBLE, rate DOUBLE, payment DOUBLE, months INT) RETURNS DOUBLE":
            "CASE WHEN rate = 0 THEN amount - payment * months ELSE amount * pow(1.0D + rate / 1200.0D, months) "
            "- try_divide(payment * (pow(1.0D + rate / 1200.0D, months) - 1.0D), rate / 1200.0D) END",
        "scheduled_balance(amount DOUBLE, rate DOUBLE, term INT, months INT) RETURNS DOUBLE":
            f"CASE WHEN NOT term > 0 THEN NULL WHEN months < term THEN {q}balance_after(amount, rate, "
            f"{q}level_payment(amount, rate, term), months) WHEN months = term THEN 0.0D "
            f"WHEN months > term THEN {BEYOND_TERM}D END",
        "loan_schedule(amount DOUBLE, rate DOUBLE, term INT, months INT) RETURNS TABLE(LOAN_AGE INT, SCHD_UPB DOUBLE)":
            f"SELECT age, {q}scheduled_balance(amount, rate, term, age) FROM explode("
            "CASE WHEN months > 0 THEN sequence(0, months - 1) END) AS t(age)",
    }


FUNCTIONS = tuple(s.split("(", 1)[0] for s in _bodies(""))


def create_functions(spark: SparkSession, database: str | None = None) -> list[str]:
    """Create (or replace) the functions: temporary ones, or in ``database`` of the catalog; their names."""
    if database is not None:
        if not _NAME.match(database):
            raise ValueError(f"not a plain identifier: {database!r}")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    q = "" if database is None else f"{database}."
    kind = "TEMPORARY FUNCTION" if database is None else "FUNCTION"
    for signature, body in _bodies(q).items():
        spark.sql(f"CREATE OR REPLACE {kind} {q}{signature} RETURN {body}")
    return [q + f for f in FUNCTIONS]
