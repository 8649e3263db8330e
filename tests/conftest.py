import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lodestar.session import get_session
    s = get_session("local[4]", shuffle_partitions=4, extra={"spark.driver.memory": "6g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def as_of():
    import datetime as dt
    return dt.datetime(2026, 9, 15, 12, 0, 0, tzinfo=dt.timezone.utc)
