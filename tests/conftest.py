import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mortar.session import build_session  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    conf = {"spark.sql.shuffle.partitions": "8"}
    s = build_session("local[*]", "mortar-tests", **conf)
    # Tests set their own checkpoint folder only when the session has none.
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="mortar-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(spark):
    from mortar.session import scratch_path
    return scratch_path(spark, "test")
