import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tessera.session import build_session, checkpoint_dir

    s = build_session(master="local[4]", shuffle_partitions=4, app_name="tessera-tests")
    checkpoint_dir(s)  # unset in tests -> a private folder
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def rows(df, *cols):
    cols = cols or df.columns
    def key(tup):
        return tuple((x is None, x if x is not None else 0) for x in tup)

    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=key)


SF_SMALL = "/root/testdata/sf0.001"
