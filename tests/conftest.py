import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from marketlens.session import checkpoint_dir, get_session
    s = get_session("local[*]", 8)
    checkpoint_dir(s)
    yield s
