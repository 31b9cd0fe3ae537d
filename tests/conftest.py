import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from sluice.session import checkpoint_root, local_session

    s = local_session(4, shuffle_partitions=8, app="sluice-tests")
    checkpoint_root(s)  # sets one only if the session has none (tests)
    yield s


def pytest_configure(config):
    for m in ("unit", "integration", "e2e", "slow", "spark"):
        config.addinivalue_line("markers", f"{m}: {m} tests")
