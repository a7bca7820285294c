import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from tempora.session import build

    session = build("local[4]", "tests", spark__sql__shuffle__partitions="4", spark__driver__memory="4g", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__sql__adaptive__coalescePartitions__parallelismFirst="false")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
