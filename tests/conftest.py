import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from calyx.session import build_session
    s = build_session("local[4]", app_name="calyx-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    # tests own their checkpoint folder; a cluster names it in spark.checkpoint.dir
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="calyx-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_table(spark):
    from calyx.session import scratch_path

    def make(name="t"):
        return scratch_path(spark, name)
    return make
