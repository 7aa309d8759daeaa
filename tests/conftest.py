import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from pricecraft.session import get_spark
    s = get_spark("local[*]", app="pricecraft-tests", shuffle_partitions=8, extra={
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g", "spark.sql.execution.arrow.maxRecordsPerBatch": "50"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    from pricecraft.session import cleanup
    cleanup(s)


SF_SMALL = "/root/testdata/sf0.001"
