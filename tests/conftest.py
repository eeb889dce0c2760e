import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = os.environ.get("STAFFRANK_TEST_SF", SF_SMALL)


@pytest.fixture(scope="session")
def spark():
    from staffrank.session import build_session

    s = build_session(master="local[*]", shuffle_partitions=8, app="staffrank-tests")
    yield s
    s.stop()
