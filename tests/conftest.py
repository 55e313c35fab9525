import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from chatsift.session import local_session

    s = local_session("*", 8)
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate a Column expression on a one-row frame of given columns."""
    def run(expr, schema="t string", values=(None,)):
        df = spark.createDataFrame([tuple(values)], schema)
        return df.select(expr.alias("v")).first()["v"]
    return run
