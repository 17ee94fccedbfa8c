import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from hardwood.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="8", partitions=4)
    # On a handful of rows compiling a plan takes longer than running it.
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """DataFrame from rows and a DDL schema."""
    def build(rows, schema):
        return spark.createDataFrame(rows, schema)

    return build
