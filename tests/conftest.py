import os
import sys
from datetime import datetime, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("TZ", "UTC")


@pytest.fixture(scope="session")
def spark():
    from railyard.session import build_session, shared_dir
    s = build_session("local[4]", shuffle_partitions=4, app_name="railyard-tests")
    shared_dir(s)
    yield s
    s.stop()


def utc(*args) -> datetime:
    return datetime(*args, tzinfo=timezone.utc)


def iso(dt: datetime) -> str:
    return dt.isoformat()
