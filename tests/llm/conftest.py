import os

import pytest


@pytest.fixture(autouse=True)
def importable(spark):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment["PYTHONPATH"] = root
