import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from barloom.session import clear_stages, local_session

    session = local_session(shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_stages(session)
    session.stop()
