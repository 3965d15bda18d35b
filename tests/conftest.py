import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from forgeline.session import build_session
    s = build_session("local[4]", 8, app_name="forgeline-tests", extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


SMALL = "/root/testdata/sf0.001"
