import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from canopus.session import build_session
    s = build_session(master="local[4]", app="canopus-tests", shuffle_partitions=4, extra={
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
        "spark.sql.session.timeZone": "UTC"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
