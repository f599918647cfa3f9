import os
import sys
import tempfile

import time

import pytest

os.environ["TZ"] = "UTC"  # naive datetimes in hand-made rows are UTC
time.tzset()

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from playpulse.config import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="playpulse-test-ckpt-")
    s = build_session(
        "playpulse-tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": ckpt,
            "spark.driver.memory": "4g",
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="playpulse-test-")
