import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pointgate.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("pointgate-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        # Many small Arrow batches, so that state has to survive their borders.
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()
