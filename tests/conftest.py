import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from listledger.session import checkpoint_dir, local_session

    s = local_session(cores="*", shuffle_partitions=8)
    checkpoint_dir(s)
    yield s


def rows(df, *cols):
    return [tuple(r[c] for c in cols) if cols else tuple(r) for r in df.collect()]
