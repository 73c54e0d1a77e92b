import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
GOLDEN_JOIN = os.path.join(ROOT, "tests", "fixtures", "catalog_join_golden.tsv")


@pytest.fixture(scope="session")
def spark():
    from lanthorn.session import get_session

    os.environ.setdefault("LANTHORN_SHUFFLE_PARTITIONS", "8")
    s = get_session(master="local[*]", shuffle_partitions=8, app_name="lanthorn-tests")
    yield s
    s.stop()
