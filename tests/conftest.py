import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from episodic.session import get_session
    s = get_session("local[4]", shuffle_partitions=4, app="episodic-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples (None sorts first) for order-insensitive comparison."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is not None, x) for x in t))
