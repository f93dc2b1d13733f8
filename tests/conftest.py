import os
import sys
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from skein.session import get_spark
    return get_spark(master="local[4]", shuffle_partitions=8)


def hours(n, start=datetime(2024, 1, 1)):
    return [start + timedelta(hours=i) for i in range(n)]


@pytest.fixture
def panel(spark):
    """Build a panel DataFrame from rows (id, market, delivery_start, target, x)."""
    def make(rows, features=("x",)):
        schema = "id long, market string, delivery_start timestamp_ntz, target double, " + ", ".join(
            f"{f} double" for f in features)
        return spark.createDataFrame(rows, schema)
    return make
