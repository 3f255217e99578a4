"""Look-back features on the stream of monthly rows, with state per loan.

The batch features of ``operators.panel`` and ``operators.events`` that look
back (status of the row before, statuses of the twelve rows before, first
modification, first serious delinquency) need twelve statuses and two flags
of a loan, so they run on the stream: rows get their features when they land.
Looking ahead needs the future and stays in batch.

Rows of a loan must come in time order from run to run.  A row for a month at
or before the loan's last one is late: it is kept, marked, without features,
and changes no state (``late_rows`` lists them; a restatement belongs into
``restate``).  Lateness is judged per loan, not by a watermark over the stream,
which would drop one loan's month because others are ahead.

State is at most a dozen numbers per loan in Spark's state store.  A call of
the state function costs much more than a loan's rows, and a monthly tape has
nearly every loan, so loans are grouped by a hash of their id into at most
``BUCKETS`` groups, each with the states of its loans.  A task holds the rows
of one bucket and micro-batch, so cut a large backlog by
``max_files_per_trigger`` or ``max_bytes_per_trigger``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import groupby

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.clean import performance_base
from ..operators.events import SERIOUS_DLQ
from ..operators.panel import LOOK_BACK
from ..schema import Agency
from .ingest import landing_stream

# Executors need only pandas, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CARRIED = ("LOAN_ID", "ACT_DTE", "LOAN_AGE", "DLQ_STATUS", "MOD_FLAG", "ZB_CODE", "LAST_UPB")
ORDER = ("ACT_DTE", "LOAN_AGE", "DLQ_STATUS", "ZB_CODE", "MOD_FLAG", "LAST_UPB")
OUTPUT = ("LOAN_ID string, ACT_DTE date, LOAN_AGE int, DLQ_STATUS int, MOD_FLAG string, ZB_CODE string, LAST_UPB double, "
          "DLQ_LAG int, DLQ_LAGs12 array<int>, FIRST_MOD boolean, FIRST_90D boolean, LATE boolean")
# the loans of a bucket, in the same order in each array
STATE = ("loans array<string>, last array<date>, statuses array<array<int>>, modified array<boolean>, "
         "serious array<boolean>")
# Groups of the state function; a checkpoint keeps the number it began with.
BUCKETS = 8192
_UNSEEN = (None, [], False, False)


def _step(rows: list[dict], state: tuple, look_back: int, serious_from: int) -> tuple[list[dict], tuple]:
    """Features of a loan's new rows in time order, and its state after them."""
    last, statuses, modified, serious = state
    statuses, begun, out = list(statuses), last, []
    for r in rows:
        late = begun is not None and r["ACT_DTE"] <= begun
        row = {**r, "DLQ_LAG": None, "DLQ_LAGs12": None, "FIRST_MOD": None, "FIRST_90D": None, "LATE": late}
        if not late:
            status = r["DLQ_STATUS"]
            is_mod, is_serious = r["MOD_FLAG"] == "Y", status is not None and status >= serious_from
            row.update(DLQ_LAG=statuses[-1] if statuses else None, DLQ_LAGs12=[s for s in statuses if s is not None],
                       FIRST_MOD=is_mod and not modified, FIRST_90D=is_serious and not serious)
            statuses = (statuses + [status])[-look_back:]
            last, modified, serious = r["ACT_DTE"], modified or is_mod, serious or is_serious
        out.append(row)
    return out, (last, statuses, modified, serious)


def lookback_stream(stream: DataFrame, look_back: int = LOOK_BACK) -> DataFrame:
    """Streamed monthly rows (see ``performance_base``) with their look-back features."""
    serious_from = SERIOUS_DLQ + 1

    def update(key: tuple, frames: Iterator, state: GroupState) -> Iterator:
        import pandas as pd

        rows = []
        for frame in frames:
            frame = frame[list(CARRIED)]
            plain = frame.astype(object).where(frame.notna(), None)
            rows += plain.to_dict("records")
        for r in rows:
            for c in ("LOAN_AGE", "DLQ_STATUS"):
                r[c] = None if r[c] is None else int(r[c])
        rows.sort(key=lambda r: (r["LOAN_ID"], *((r[c] is not None, 0 if r[c] is None else r[c]) for c in ORDER)))
        states = {loan: known for loan, *known in zip(*state.get)} if state.exists else {}
        out = []
        for loan, own in groupby(rows, key=lambda r: r["LOAN_ID"]):
            made, states[loan] = _step(list(own), states.get(loan, _UNSEEN), look_back, serious_from)
            out += made
        state.update((list(states), *map(list, zip(*states.values()))))
        made = pd.DataFrame(out, dtype=object)
        for c in ("LOAN_AGE", "DLQ_STATUS", "DLQ_LAG"):
            made[c] = made[c].astype("Int32")
        for c in ("FIRST_MOD", "FIRST_90D", "LATE"):
            made[c] = made[c].astype("boolean")
        for c in ("MOD_FLAG", "ZB_CODE"):
            made[c] = made[c].astype("string")
        made["LAST_UPB"] = made["LAST_UPB"].astype("Float64")
        yield made

    rows = stream.where(F.col("LOAN_ID").isNotNull() & F.col("ACT_DTE").isNotNull()).select(
        *CARRIED, F.pmod(F.xxhash64("LOAN_ID"), F.lit(BUCKETS)).alias("bucket"))
    return rows.groupBy("bucket").applyInPandasWithState(update, OUTPUT, STATE, "append", GroupStateTimeout.NoTimeout)


def ingest_lookback(spark: SparkSession, source_dir: str, target_dir: str, checkpoint_dir: str,
                    agency: str | Agency = "FNMA", max_files_per_trigger: int | None = None,
                    max_bytes_per_trigger: str | None = None) -> str:
    """Land every new tape file with its look-back features, then stop; a rerun goes on from the checkpoint."""
    stream = landing_stream(spark, source_dir, agency, max_files_per_trigger, max_bytes_per_trigger, performance_base)
    query = lookback_stream(stream).writeStream.format("parquet").option("path", target_dir).option(
        "checkpointLocation", checkpoint_dir).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return target_dir


def late_rows(landed: DataFrame) -> DataFrame:
    """Rows that came after a later month of their loan had landed."""
    return landed.where("LATE")
