"""One local session per test run; scratch folders come from ``tmp_path``."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from shelfwise.session import build_session  # noqa: E402

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "shelfwise-tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="6g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return str(DATA / "sf0.001")


@pytest.fixture(scope="session")
def medium():
    return str(DATA / "sf0.01")
