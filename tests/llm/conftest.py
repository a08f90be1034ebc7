import pytest
from edge_rows import EDGES, frame


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def edges(spark):
    return frame(spark, EDGES)


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [])
