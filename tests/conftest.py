import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orefold.session import create_session  # noqa: E402
from orefold.sinks.lake import Lake  # noqa: E402

SAMPLE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = create_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


@pytest.fixture(scope="session")
def sample():
    if not os.path.isdir(SAMPLE):
        pytest.skip("sample tables are not here")
    return SAMPLE


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""
    def collect(df, *columns):
        return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)
    return collect
