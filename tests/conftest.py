import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = os.environ.get("MARTFORGE_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from martforge.session import build_session, shared_dir

    s = build_session("local[*]", app="martforge-tests", shuffle_partitions=8,
                      spark__driver__memory="8g")
    shared_dir(s)   # tests: a local checkpoint folder when the session names none
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL


@pytest.fixture()
def tmp_uri(tmp_path):
    return str(tmp_path)
