import pytest

import fixtures


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with every awkward case, in several partitions."""
    return spark.createDataFrame(fixtures.rows(), fixtures.SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], fixtures.SCHEMA)
