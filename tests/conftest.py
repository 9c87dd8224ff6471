import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from voltlog.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(cpus=4, app_name="voltlog-tests", memory="4g", shared_folder=shared)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
