import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from viewlog.session import build_session

    base = tmp_path_factory.mktemp("spark")
    s = build_session(
        "local[4]",
        shuffle_partitions=8,
        app="viewlog-tests",
        extra={"spark.sql.warehouse.dir": str(base / "warehouse"), "spark.driver.memory": "4g"},
    )
    # Tests set their own shared directory; on a cluster it comes from the session.
    s.sparkContext.setCheckpointDir(str(base / "checkpoints"))
    yield s
    s.stop()


@pytest.fixture()
def fresh_dir(tmp_path):
    return str(tmp_path)
