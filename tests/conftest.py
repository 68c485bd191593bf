import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from marketide.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "marketide-tests",
        master="local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g",
        spark__sql__session__timeZone="UTC",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
        spark__python__sql__dataFrameDebugging__enabled="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
