import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from corpuslake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    checkpoints = str(tmp_path_factory.mktemp("checkpoints"))
    session = local_session("8", "tests", **{"spark.checkpoint.dir": checkpoints})
    yield session
    session.stop()
