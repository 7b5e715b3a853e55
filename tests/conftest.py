import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tillwise.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir_small():
    return "/root/testdata/sf0.01"
