import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from roompulse.session import build_session

    conf = {
        "spark.master": "local[4]",
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.warehouse.dir": os.environ.get("TEST_WAREHOUSE", "/tmp/roompulse-test-warehouse"),
    }
    session = build_session("roompulse-tests", conf)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
