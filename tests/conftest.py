import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from hazardspark.session import build_session

    session = build_session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Value of a column expression over one row of literals."""
    def run(fn, *args, types=None):
        from pyspark.sql import functions as F

        cols = [F.lit(a) if a is not None else F.lit(None).cast((types or "string")) for a in args]
        return spark.range(1).select(fn(*cols).alias("x")).first()["x"]

    return run
