import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cauce.session import get_session
    s = get_session("local[4]", app="cauce-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture
def tmp_table_dir(spark):
    """A fresh folder under the session's checkpoint dir (the shared scratch space)."""
    import uuid
    from cauce.session import scratch_path
    return scratch_path(spark, f"test-{uuid.uuid4().hex}")
