import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)


@pytest.fixture(autouse=True)
def shipped(spark):
    """Python workers find the package whatever the caller's PYTHONPATH is."""
    from wardflow.llm.common import ship_package
    ship_package(spark)


@pytest.fixture
def frame(spark):
    def make(rows, schema="doc_id BIGINT, text STRING"):
        return spark.createDataFrame(rows, schema)
    return make
