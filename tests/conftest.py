import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))
sys.path.insert(0, os.path.dirname(__file__))

from seispark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "tests")


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
