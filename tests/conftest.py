from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from scrubline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "scrubline-tests",
        master="local[8]",
        spark__sql__shuffle__partitions=8,
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["true", "false"], ids=["ansi", "no-ansi"])
def ansi(spark, request):
    """Run a test with ANSI mode on and off."""
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.unset("spark.sql.ansi.enabled")
