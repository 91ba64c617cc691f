import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from fieldnotes.session import get_spark
    conf = {"spark.driver.memory": "4g"}
    # a folder of the tests' own, as no cluster names one here
    s = get_spark("tests", master="local[4]", shuffle_partitions=8, conf=conf,
                  scratch=tempfile.mkdtemp(prefix="fieldnotes-tests-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
