import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ampere.session import get_session
    s = get_session("local[4]", 4, app_name="ampere-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def ts(s):
    import datetime as dt
    return dt.datetime.fromisoformat(s)
