import os
import sys
import tempfile

import pytest

_TESTS = os.path.dirname(os.path.abspath(__file__))
_REPO = os.path.dirname(_TESTS)
sys.path.insert(0, _REPO)
# Python workers start from the JVM's environment: let them import the
# package and test helpers (e.g. stub detectors defined in test modules).
os.environ["PYTHONPATH"] = os.pathsep.join(
    p for p in (_REPO, _TESTS, os.environ.get("PYTHONPATH", "")) if p
)

from chanmart.session import checkpoint_dir, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(app="chanmart-tests", cores="*", shuffle_partitions=8)
    # Tests own the session: only here is a checkpoint folder set when the
    # session does not name one.
    checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="chanmart-ckpt-"))
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="chanmart-test-")
