import os
import sys

import pytest

_HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, _HERE)


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Small tables: fewer tasks, same code."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
