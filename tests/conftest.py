import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabfold.session import local_session

DATA = os.environ.get("TABFOLD_DATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return f"{DATA}/sf0.001"
