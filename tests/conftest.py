import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakepipe.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="lakepipe-test-ckpt-")
    s = build_session(master="local[4]", shuffle_partitions=4, app="lakepipe-tests",
                      extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g",
                             "spark.sql.warehouse.dir": ckpt + "/warehouse"})
    s.sparkContext.setCheckpointDir(ckpt)
    yield s


@pytest.fixture()
def tmp_root(tmp_path):
    return str(tmp_path)
