import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quotelake.session import get_session
    s = get_session(master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from quotelake.session import scratch_path
    return lambda name="t": scratch_path(spark, name)


def ts(text):
    import datetime as dt
    return dt.datetime.fromisoformat(text)
