import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from catalog_spark.session import build_session  # noqa: E402

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", spark_sql_shuffle_partitions="4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    if not DATA.exists():
        pytest.skip("no test data")
    return str(DATA)


@pytest.fixture
def rows(spark):
    """Rows as a DataFrame."""
    return lambda values, schema: spark.createDataFrame(values, schema)
