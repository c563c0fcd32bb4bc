import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tenorgrid.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", 8, spark__driver__memory="8g",
                            spark__python__sql__dataFrameDebugging__enabled="false")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
