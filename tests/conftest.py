import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from patronflow.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("patronflow-tests", master="local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.driver.memory": "6g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collect a DataFrame as a sorted list of plain tuples."""
    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)
    return collect
