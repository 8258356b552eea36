import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from clickseg.session import build_session

    # The tests' own checkpoint folder.
    s = build_session(master="local[*]", shuffle_partitions=8,
                      checkpoint_dir=tempfile.mkdtemp(prefix="ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
