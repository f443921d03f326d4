import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flowguard.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="fg-test-ckpt-")
    s = build_session("local[4]", shuffle_partitions=4, conf={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()
