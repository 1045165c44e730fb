from __future__ import annotations

import os
import sys
import time
from pathlib import Path

import pytest

os.environ["TZ"] = "UTC"  # naive datetimes in test rows mean UTC
time.tzset()

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from curbline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "curbline-tests",
        spark__master="local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__default__parallelism="4",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
