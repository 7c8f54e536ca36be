import pytest

from sitescore.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("8", partitions=8, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
