import pytest

from tests.llm import common


@pytest.fixture(scope="session")
def awkward_docs(spark):
    """The awkward texts, one of them repeated as a whole row, and rows without an id."""
    rows = common.rows(common.awkward())
    return spark.createDataFrame([*rows, rows[0], (None, "no id here", "en", "s0", 1, "k", "i", 0)], common.DOCS).repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], common.DOCS)
