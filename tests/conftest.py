import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tideline.session import builder  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        builder("tideline-tests")
        .master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """Rows to a frame; ``ts`` in the schema stands for timestamp_ntz."""

    def make(rows, schema):
        return spark.createDataFrame(rows, schema.replace(" ts", " timestamp_ntz"))

    return make


def day(n, hour=0, month=1):
    return datetime(2024, month, n, hour)
