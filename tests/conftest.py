import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from marquee.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=8, partitions=4, memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL
