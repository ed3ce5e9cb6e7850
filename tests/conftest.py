import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from ledgerlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=4, app_name="ledgerlake-tests")
    if not s.sparkContext.getCheckpointDir():
        # Tests name their own shared folder; a cluster names it in spark.checkpoint.dir.
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlake-test-"))
    yield s
    s.stop()
