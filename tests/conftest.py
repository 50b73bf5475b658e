from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stratalog.session import local_session, shared_root  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setLogLevel("OFF")
    shared_root(session)
    yield session
    session.stop()


@pytest.fixture
def values():
    """Rows of a frame as sorted tuples in the given column order."""

    def get(df, *columns):
        rows = [tuple(r[c] for c in columns) for r in df.select(*columns).collect()]
        return sorted(rows, key=lambda r: tuple((x is not None, str(type(x)), x) for x in r))

    return get
