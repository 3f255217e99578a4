"""mortar: loan-level mortgage performance analytics on Spark.

Typical use::

    from mortar import build, save, read_tape, agency
    fnma = agency("FNMA")
    level = build(read_tape(spark, perf_path, fnma.performance),
                  read_tape(spark, acq_path, fnma.acquisition), fnma)
    save(level, result_folder, "2000Q1")   # Loan and LoanPerformance by vintage
"""

from .plans.loan_level import LoanLevel, build, save
from .schema import FNMA, FRED, agency
from .session import build_session, checkpoint_root
from .sources.text import read_acquisition, read_performance, read_tape, write_tape

__all__ = [
    "FNMA", "FRED", "LoanLevel", "agency", "build", "build_session", "checkpoint_root",
    "read_acquisition", "read_performance", "read_tape", "save", "write_tape",
]
