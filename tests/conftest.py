import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallyline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    session = local_session(
        "tests", cores=4, spark__checkpoint__dir=shared, spark__sql__warehouse__dir=warehouse
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def matches(spark):
    """A small mart_match_results with ties, a scoreless row and a team in two competitions."""
    from tests.data import MATCH_ROWS, MATCH_SCHEMA

    return spark.createDataFrame(MATCH_ROWS, MATCH_SCHEMA)
