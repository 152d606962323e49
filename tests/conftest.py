from __future__ import annotations

import pytest

from tierlake.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tierlake-tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    """A fresh path for a table."""
    return str(tmp_path / "table")
