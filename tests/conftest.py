import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from lodgeflow.session import build_session, ensure_checkpoint_dir
    s = build_session("local[*]", app="lodgeflow-tests", shuffle_partitions=8)
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)
