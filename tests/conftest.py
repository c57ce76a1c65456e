from __future__ import annotations

import os

import pytest

from hypnolith.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[4]",
        app_name="hypnolith-tests",
        shuffle_partitions=4,
        extra={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw_folder():
    folder = "/root/testdata/sf0.001"
    if not os.path.exists(f"{folder}/events.parquet"):
        pytest.skip("no raw tables to load")
    return folder
