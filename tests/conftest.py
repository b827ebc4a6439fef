import pytest

from scanledger.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "scanledger-tests")
    session.sparkContext.setLogLevel("ERROR")
    return session
