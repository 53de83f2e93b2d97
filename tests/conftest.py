import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pagelex.session import get_spark

    s = get_spark("local[4]", app="pagelex-tests", partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_fresh(tmp_path):
    return tmp_path
