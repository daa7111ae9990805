import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from archivolt.session import build

    s = build("local[4]", 4)
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    return s


@pytest.fixture(scope="session")
def smoke_dir():
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no test tables here")
    return path
