from __future__ import annotations

import pytest

from trajlake import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 4)
    yield session
    session.stop()
