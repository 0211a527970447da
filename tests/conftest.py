import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ideaweave.session import build_session, checkpoint_dir
    s = build_session("local[4]", 8, app="ideaweave-tests")
    checkpoint_dir(s, tempfile.mkdtemp(prefix="iw-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="iw-test-")
