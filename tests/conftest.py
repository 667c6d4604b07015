import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]
os.environ["PYTHONPATH"] = f"{ROOT}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"
SPACE = tempfile.mkdtemp(prefix="gridloom-tests-")
os.environ["GRIDLOOM_ALLOW_PATH"] = f"{SPACE}{os.pathsep}{tempfile.gettempdir()}"


@pytest.fixture(scope="session")
def spark():
    from gridloom.session import session

    s = session(
        "tests", "local[4]",
        **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": f"{SPACE}/checkpoints", "spark.driver.memory": "4g"},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def folder(tmp_path):
    """A folder that local paths may be in."""
    before = os.environ["GRIDLOOM_ALLOW_PATH"]
    os.environ["GRIDLOOM_ALLOW_PATH"] = f"{tmp_path}{os.pathsep}{before}"
    yield tmp_path
    os.environ["GRIDLOOM_ALLOW_PATH"] = before
