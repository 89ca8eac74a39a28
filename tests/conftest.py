import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from snapledger.session import build_session, checkpoint_dir  # noqa: E402

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[8]", shuffle_partitions=8, extra={"spark.driver.memory": "8g"})
    # Tests only: the session names no shared checkpoint folder, so use a fresh scratch one.
    checkpoint_dir(s, tempfile.mkdtemp(prefix="run-ckpt-", dir="/tmp"))
    yield s


@pytest.fixture
def lake_root(tmp_path):
    return str(tmp_path / "lake")
