import pytest
from edge_rows import EDGES, frame


@pytest.fixture(scope="session")
def edges(spark):
    return frame(spark, EDGES)


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [])
