import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from reelframe.session import build_session

    session = build_session("local[4]", app_name="reelframe-tests", shuffle_partitions=8,
                            driver_memory="4g")
    # tests own their checkpoint folder; on a cluster spark.checkpoint.dir is set already
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="reelframe-test-ckpt-"))
    yield session
    session.stop()


def rows(df, *cols):
    """Sorted list of tuples (for order-insensitive comparisons)."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
