import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from overround.session import build_session

    s = build_session("local[4]", shuffle_partitions=8, app_name="overround-tests")
    yield s
    s.stop()


def rows(df, order=None):
    """Collect as a list of dicts (sorted for order-insensitive checks)."""
    out = [r.asDict() for r in df.collect()]
    if order:
        out.sort(key=lambda r: tuple((r[c] is None, r[c]) for c in order))
    return out
