import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tagloom.session import ensure_utc, local_session  # noqa: E402

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tagloom-tests", cores="8", shuffle_partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    yield ensure_utc(session)
    session.stop()
