import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tripmill.session import session  # noqa: E402

TEST_DATA = "/root/testdata"


def new_session():
    spark = session(
        "tripmill-tests",
        master="local[8]",
        settings={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "8",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tripmill-tests-"))
    return spark


@pytest.fixture(scope="session")
def spark():
    s = new_session()
    yield s
    s.stop()
