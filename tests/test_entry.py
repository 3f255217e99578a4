"""The driver contract from a fresh process outside the repository."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
import __spark_entry__ as e
assert e.entry(spark).count() > 0
# the payment kernel runs in Python workers that cannot import the package
print("ROWS", e.queries()["payment_table"](spark, "/root/testdata/sf0.001").count())
spark.stop()
"""


def test_entry_and_python_kernel_from_foreign_directory():
    cwd = tempfile.mkdtemp(prefix="mortar-entry-")
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "ROWS 202800" in out.stdout
