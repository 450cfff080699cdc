import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=4, extra={"spark.driver.memory": "4g"})
    yield s


def one(spark, expr, value, schema="t string"):
    """Evaluate a column expression on a one-row DataFrame."""
    from pyspark.sql import Row
    df = spark.createDataFrame([Row(t=value)], schema)
    return df.select(expr.alias("r")).first()["r"]
