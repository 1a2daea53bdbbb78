import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from market_engine.session import checkpoint_dir, get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    wh = tempfile.mkdtemp(prefix="run-wh-", dir="/tmp")
    s = get_session("local[4]", app="market_engine_tests", shuffle_partitions=4,
                    conf={"spark.sql.warehouse.dir": wh, "spark.driver.memory": "4g"})
    checkpoint_dir(s, tempfile.mkdtemp(prefix="run-ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture
def tmp_path_run():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
