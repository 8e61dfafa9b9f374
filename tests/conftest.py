import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from navedge.session import get_session
    from navedge.session import checkpoint_root
    s = get_session("local[*]", app="navedge-tests", conf={"spark.sql.shuffle.partitions": "8"})
    checkpoint_root(s)  # the configured shared folder, or a temporary one if none is set
    yield s
    s.stop()


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="navedge-test-")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
