import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import cases  # noqa: E402


@pytest.fixture(scope="session")
def rows():
    return cases.corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return cases.frame(spark, rows).repartition(4).persist()


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")
