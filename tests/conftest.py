import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from lakepipe.session import local_session  # noqa: E402
from lakepipe.schemas import raw_schema  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = local_session(
        4,
        shuffle_partitions=4,
        memory="4g",
        spark__sql__warehouse__dir=str(base / "warehouse"),
        spark__checkpoint__dir=str(base / "shared"),
    )
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set options for one test."""
    before = {}

    def put(key, value):
        before.setdefault(key, spark.conf.get(key))
        spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture
def raw(spark):
    """Rows of the raw feed from tuples (time, type, product, brand, price, user, session)."""
    import datetime

    def build(rows):
        def at(t):
            return datetime.datetime.fromisoformat(t) if isinstance(t, str) else t

        return spark.createDataFrame([(at(r[0]), *r[1:]) for r in rows], raw_schema())

    return build
