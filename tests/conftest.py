import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from orderlake.session import get_spark
    s = get_spark("local[4]", 8, extra_conf={"spark.ui.showConsoleProgress": "false"})
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="orderlake-test-", dir="/tmp"))
    yield s


@pytest.fixture()
def tmpdir_spark():
    return tempfile.mkdtemp(prefix="orderlake-t-", dir="/tmp")
