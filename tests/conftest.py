from __future__ import annotations

import pytest

from tests.compare import connect
from tests.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = local_session("4", **{"spark.checkpoint.dir": str(folder), "spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture(scope="session")
def con(sf_dir):
    return connect(sf_dir)
