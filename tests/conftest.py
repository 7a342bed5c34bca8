import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("OMP_NUM_THREADS", "1")

from obsforge.session import build_session, ship_package  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", 4, **{"spark.driver.memory": "3g", "spark.sql.autoBroadcastJoinThreshold": "1m"})
    ship_package(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


@pytest.fixture
def as_rows():
    return rows
