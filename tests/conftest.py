from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pulsefold.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "pulsefold-tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g", spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Literal rows to a DataFrame: frame("a int, b double", (1, 2.0), ...)."""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)


@pytest.fixture
def events_dir():
    return "/root/testdata/sf0.001"
