import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from fishladder.session import build_session, checkpoint_dir
    s = build_session("local[4]", app="fishladder-tests", shuffle_partitions=4)
    checkpoint_dir(s, tempfile.mkdtemp(prefix="fishladder-ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="fishladder-test-", dir="/tmp")


def rows(df, *cols):
    cols = cols or df.columns
    return sorted([tuple(r[c] for c in cols) for r in df.collect()], key=lambda t: tuple(str(x) for x in t))
