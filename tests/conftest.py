import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pulsekit.session import get_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="pulsekit-test-ckpt-")
    s = get_session("local[4]", 8, app="pulsekit-tests",
                    extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    yield s
