import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tierwise.session import build_session
    # Checkpoint folder: the session's spark.checkpoint.dir if the environment names one,
    # else tierwise.session.shared_root() registers a private one.
    s = build_session("local[*]", 8, "tierwise-tests")
    yield s
    s.stop()


def rows(df, *cols):
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.collect()]
