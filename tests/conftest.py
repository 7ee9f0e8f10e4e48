import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_TINY = "/root/testdata/sf0.001"
SF_SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from fleetframe.session import build_session, checkpoint_root
    s = build_session(master="local[4]", shuffle_partitions=4, app_name="fleetframe-tests")
    checkpoint_root(s)
    yield s


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)


def _key(row):
    return tuple((v is None, v if v is not None else 0) for v in row)


def rows_of(df):
    """Collected rows in a canonical order (NULLs sort first, per column)."""
    return sorted((tuple(r) for r in df.collect()), key=_key)
