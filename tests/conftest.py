import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from silverloom.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", "4")


@pytest.fixture
def frame(spark):
    """A DataFrame from a schema text and row tuples."""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)


def rows(df, *order):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))
