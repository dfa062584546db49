import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from mise.session import ensure_checkpoint_dir, get_session
    s = get_session(app="mise-tests", master="local[4]", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s, str(tmp_path_factory.mktemp("ckpt")))
    yield s
