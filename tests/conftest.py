import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from listmill.session import local_session

    folder = str(tmp_path_factory.mktemp("checkpoints"))
    session = local_session("4", "tests", **{"spark.checkpoint.dir": folder, "spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()
