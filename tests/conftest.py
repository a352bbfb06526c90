import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from tallyward.session import local_session  # noqa: E402

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tallyward-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_small():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def sf_check():
    return f"{TESTDATA}/sf0.01"
