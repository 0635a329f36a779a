import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from barlake.session import checkpoint_dir, local_session
    s = local_session(4, shuffle_partitions=4, app="barlake-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="barlake-test-ckpt-")})
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="barlake-test-")
