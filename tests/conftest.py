import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tripmart.session import local_session

    s = local_session(shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def lake(spark):
    from tripmart.plans.lake import Lake

    return Lake(spark, SMALL)
