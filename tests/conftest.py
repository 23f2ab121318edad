import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

os.environ.setdefault("TILLWISE_SCRATCH", tempfile.mkdtemp(prefix="tests-", dir="/tmp"))


@pytest.fixture(scope="session")
def spark():
    from tillwise.session import local_session
    s = local_session("*", 8, app="tillwise-tests")
    yield s
    s.stop()


SF = "/root/testdata/sf0.001"
