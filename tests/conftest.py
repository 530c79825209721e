import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from enrichkit.session import get_session, scratch_path  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[*]", app_name="enrichkit-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture
def tmp_table(spark):
    """A fresh path under the session's checkpoint root."""
    return lambda name="t": scratch_path(spark, name)
