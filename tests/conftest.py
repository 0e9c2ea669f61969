import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from panelweave.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(cores=8, app="tests", partitions=4)
