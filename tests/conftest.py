import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import build_session, make_importable  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", 4, spark__sql__adaptive__coalescePartitions__parallelismFirst="false", spark__driver__memory="4g", spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    make_importable(session)
    yield session
