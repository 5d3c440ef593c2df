import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from marketlake.session import build_session
    ckpt = tempfile.mkdtemp(prefix="marketlake-test-ckpt-")
    s = build_session("local[8]", app_name="marketlake-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="marketlake-test-")


def rows(df, *cols):
    """Sorted list of tuples (optionally of selected columns)."""
    if cols:
        df = df.select(*cols)
    return sorted(tuple(r) for r in df.collect())
