import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from reviewlens.session import local_session, release  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(str(tmp_path_factory.mktemp("settled")), "8", 4)
    yield session
    release(session)


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
