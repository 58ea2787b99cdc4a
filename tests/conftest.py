import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from dossier.session import local_session
    session = local_session(8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("test tables are not there")
    return SF
