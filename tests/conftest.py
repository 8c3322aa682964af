import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from oracles.compare import session
    from terrace.session import tune
    s = session(partitions="2")
    s.sparkContext.setLogLevel("ERROR")
    return tune(s)


@pytest.fixture(scope="session")
def sf_dir():
    return SF
