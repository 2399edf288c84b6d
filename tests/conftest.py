import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.compare import oracle_connection  # noqa: E402
from tests.session import local_session  # noqa: E402

FOLDER = os.environ.get("LEDGERLOOM_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def oracle(folder):
    return oracle_connection(folder)
