import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
os.environ["PYTHONPATH"] = os.pathsep.join([str(Path(__file__).resolve().parents[1]), os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lexiloom.session import get_session

    shared = tmp_path_factory.mktemp("shared")
    session = get_session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": f"file://{shared}", "spark.driver.memory": "4g", "spark.sql.warehouse.dir": str(shared / "warehouse")})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
