import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from logweave.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", app="logweave-tests", shuffle_partitions=4)
    yield s
    s.stop()


def rows(df, *cols):
    """Collect as sorted tuples (optionally a column subset)."""
    d = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in d.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
