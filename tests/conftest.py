import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from parcelworks.session import local_session

    shared = str(tmp_path_factory.mktemp("shared"))
    return local_session(shared, **{"spark.python.sql.dataFrameDebugging.enabled": "false"})
