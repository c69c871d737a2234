import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from scenecast.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="scenecast-test-ckpt-")   # one machine only
    s = get_session("local[*]", "scenecast-tests", conf={
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": ckpt,
    })
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
