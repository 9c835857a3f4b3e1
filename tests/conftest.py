import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starloom.session import local_session  # noqa: E402
from starloom.sources.workspace import Workspace  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, 4)
    yield session
    session.stop()


@pytest.fixture
def work(spark, request):
    return Workspace(spark, request.node.name.split("[")[0])


@pytest.fixture
def rating_table(spark):
    """Make a (user, item, rating, ts) table from triples; ts follows the order."""

    def make(rows):
        return spark.createDataFrame(
            [(u, i, float(r), n) for n, (u, i, r) in enumerate(rows)], "user bigint, item bigint, rating double, ts bigint"
        )

    return make
