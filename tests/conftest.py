import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from hazardlens.session import local_session, shared_folder  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("hazardlens-tests", "4")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    shared_folder(session)
    yield session
    session.stop()
