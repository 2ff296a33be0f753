import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from skyroute.session import get_spark
    s = get_spark(master="local[*]", shuffle_partitions=8)
    yield s


def rows(df, *cols):
    """Collect as a sorted list of tuples (order-insensitive comparisons)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple(map(str, t)))
