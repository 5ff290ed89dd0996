import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))


@pytest.fixture(scope="session")
def rows():
    import corpus

    return corpus.make()


@pytest.fixture(scope="session")
def docs(spark, rows):
    import corpus

    return spark.createDataFrame(rows, corpus.SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    import corpus

    return spark.createDataFrame([], corpus.SCHEMA)
