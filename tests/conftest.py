import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from fareline.session import get_session

    # tests set their own checkpoint folder only where the session has none
    s = get_session("local[4]", shuffle_partitions=8, app_name="fareline-tests")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="fareline-test-"))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


SF = "/root/testdata/sf0.001"
