from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from paytrail import session

    folder = tmp_path_factory.mktemp("shared")
    made = session.build(
        "local[4]",
        "tests",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.checkpoint.dir": f"file://{folder}", "spark.ui.showConsoleProgress": "false"},
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()
