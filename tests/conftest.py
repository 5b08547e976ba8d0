
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from oratio.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="oratio-tests",
                      checkpoint_dir=tempfile.mkdtemp(prefix="oratio-tests-"))
    yield s


@pytest.fixture(scope="session")
def sf_dir():
    return SF


def one(spark, value, col="t", dtype="string"):
    return spark.createDataFrame([(value,)], f"{col} {dtype}")
