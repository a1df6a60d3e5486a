import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tabreg.session import local_session
    s = local_session(cores=4, shuffle_partitions=4, app="tabreg-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def fx(spark):
    from tabreg.plans.fixtures import flights
    return flights(spark, SF0001)


@pytest.fixture(scope="module", autouse=True)
def release_tables():
    """Tables that a module's frames read go with the module, so that none meets another's count of folders."""
    yield
    from pyspark.sql import SparkSession

    from tabreg.sources import scratch
    spark = SparkSession.getActiveSession()
    if spark is not None:
        scratch.release(spark)
