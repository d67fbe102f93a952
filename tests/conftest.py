import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        shuffle_partitions=4,
        conf={
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
            # Tiny inputs: generating and compiling code would take most of the time.
            "spark.sql.codegen.wholeStage": os.environ.get("TEST_CODEGEN", "false"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
