import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from cdrflow.session import get_session

    s = get_session(master="local[*]", shuffle_partitions=8, app_name="cdrflow-tests")
    yield s


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
