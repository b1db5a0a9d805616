import pytest

from slipstream.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(shuffle_partitions=4, memory="6g")
