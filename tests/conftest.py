import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from acqlens.session import build_session
    s = build_session("local[4]", shuffle_partitions=4, app="acqlens-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="acqlens-test-")


def rows(df, *cols):
    """Sorted list of tuples of the given columns."""
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
