import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from deedweb.session import session

    found = session("tests", partitions=4, memory="4g")
    found.sparkContext.setLogLevel("ERROR")
    yield found


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
