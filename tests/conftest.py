import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__)))]

from cohortbench.session import local_session  # noqa: E402

# Started before the test modules load: they build columns at import.
SESSION = local_session("4", "4g", app="cohortbench-tests")


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()
