import pytest

from plumeline.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
