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
    from shortfall.session import build_session, ensure_checkpoint_dir

    s = build_session("local[4]", app="shortfall-tests", shuffle_partitions=4)
    if not s.sparkContext.getCheckpointDir() and not s.sparkContext.getConf().get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shortfall-test-ckpt-"))
    ensure_checkpoint_dir(s)
    yield s


def rows(df, *cols):
    """Collected rows as tuples, optionally projected, in a stable order."""
    if cols:
        df = df.select(*cols)
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
