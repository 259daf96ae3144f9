import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from shelfmark.session import get_spark

    s = get_spark("local[4]", 4, app="shelfmark-tests")
    # tests own their checkpoint folder (a cluster names a shared one)
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shelfmark-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
