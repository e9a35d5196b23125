import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from marketloom.session import local_session  # noqa: E402

SAMPLE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("marketloom-tests", cores=8, partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sample():
    if not Path(SAMPLE).exists():
        pytest.skip("sample tables are not there")
    return SAMPLE
