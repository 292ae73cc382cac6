import os

import pytest

from riskloom.session import local_session
from tests.oracle import DATA, connect


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = local_session(folder=str(tmp_path_factory.mktemp("staged")))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.path.join(DATA, "sf0.001")


@pytest.fixture(scope="session")
def duck():
    con = connect("sf0.001")
    yield con
    con.close()
