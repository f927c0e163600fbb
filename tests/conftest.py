import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from paydw.session import get_session

    s = get_session("local[4]", 4, app="paydw-tests")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="paydw-tests-"))
    yield s


@pytest.fixture()
def scratch(spark):
    import uuid

    from paydw.session import scratch_path

    return scratch_path(spark, "paydw-tests", uuid.uuid4().hex[:12])
