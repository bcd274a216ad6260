import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session, checkpoint_root
    s = build_session("local[4]", app_name="tidemark-tests", shuffle_partitions=4,
                      extra={"spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s)  # unset in tests -> a temporary folder of our own
    yield s
    s.stop()


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="tidemark-test-")


def rows(df, *cols):
    cols = cols or df.columns
    return sorted([tuple(r[c] for c in cols) for r in df.collect()],
                  key=lambda t: tuple((x is None, str(x)) for x in t))
