import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pelagos.session import get_spark

    s = get_spark("tests", "4", 4)
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext._pelagos_shared = "file://" + str(tmp_path_factory.mktemp("shared"))
    return s


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
