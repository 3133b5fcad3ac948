import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from pageprism.session import local_session

    return local_session(cpus=8, shuffle_partitions=4)


@pytest.fixture(scope="session")
def oracle():
    from tests.oracle import connect

    return connect("/root/testdata/sf0.001")
