import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from adlens.session import local_session, shared_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = local_session(4, **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    shared_dir(s)
    return s
