import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

DATA = os.path.join(ROOT, "tests", "data")
SF_SMALL = os.environ.get("RATELENS_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from ratelens.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8, app_name="ratelens-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def edge_dir():
    return os.path.join(DATA, "edge")


def lines_of(df, col="line", order=None):
    """Collect one small test result column (test helper only)."""
    if order is not None:
        df = df.orderBy(*order)
    return [r[col] for r in df.select(col).collect()]
